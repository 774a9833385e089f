"""Exact encoding and decoding with a merge-type sentencepiece model.

``encode`` gives the ids the sentencepiece library gives (no begin or end
ids, no sampling); ``decode`` gives the text its ``decode(ids)`` gives.

Method.  A token sequence is the merge encoding of a string exactly when
every pair of neighbours is *compatible*: merging their joined text from
single characters ends in that very pair.  So no merge queue over the text
is needed: an Aho-Corasick automaton over the vocabulary lists the pieces
that start at each position, the longest compatible one is taken, and when
none fits the encoder steps back to the previous token and shortens it.  A
bit field marks positions from which no encoding was found, so no position
fails twice.  Compatibility is decided by undoing and redoing the merges
of the two pieces and kept per pair.

The text is first cut where no piece can span the cut (before a run of
space marks, around line feeds when no piece holds one), so each distinct
chunk is encoded once per worker.

Cases: null text counts as empty; an empty text has no ids and decodes to
empty; very long texts are encoded whole (memory follows the longest text);
repeated rows give repeated results; characters outside the vocabulary
become byte ids (or the unknown id if the model has no byte pieces).
"""

from __future__ import annotations

import itertools
import re
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queryscope.llm.common import append_columns, documents, spans, text_or_empty, tokenizer_file

SPACE = "▁"
CACHE = 400_000  # distinct chunks, or pairs, kept per worker; refilled when full


class Pieces:
    """Vocabulary tables of a model file."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.bytes: dict[int, int] = {}
        self.text: dict[int, str | int] = {}
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(p[3:5], 16)] = i
                self.text[i] = int(p[3:5], 16)
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                self.ids[p] = i
                self.score[p] = sp.get_score(i)
                self.text[i] = p
        self.unk = sp.unk_id()
        self.packed = {p: i.to_bytes(4, "little") for p, i in self.ids.items()}
        self.chars = {p for p in self.ids if len(p) == 1}
        self.shorter: dict[str, str] = {}  # the longest shorter piece that starts alike
        for p in self.ids:
            k = len(p) - 1
            while k and p[:k] not in self.ids:
                k -= 1
            self.shorter[p] = p[:k]
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        # marks that no piece has after a letter: a chunk can be cut before a last one
        self.ends = {c for c in ".,;:!?" if not any(x == c and y.isascii() and y.isalpha() for p in self.ids for y, x in zip(p, p[1:]))}
        inner = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        feed = any("\n" in p for p in self.ids)
        # with a piece over a cut, the whole text is one chunk
        self.chunks = re.compile("(?s).+" if inner or feed else f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n").findall


class Encoder(dict):
    """chunk -> its ids as packed 32-bit integers."""

    def __init__(self, pieces: Pieces):
        self.p = pieces
        self.pairs: dict[tuple[str, str], bool] = {}
        self.split: dict[str, tuple[str, str] | None] = {}

    def merged(self, s: str) -> list[str]:
        """Merge from single characters: best score first, leftmost on ties."""
        parts, score = list(s), self.p.score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                v = score.get(parts[i] + parts[i + 1])
                if v is not None and (best is None or v > best):
                    best, at = v, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def halves(self, s: str) -> tuple[str, str] | None:
        """The pair whose merge made piece ``s``; None for a single character."""
        if s not in self.split:
            parts = list(s)
            while len(parts) > 2:
                best, at = None, -1
                for i in range(len(parts) - 1):
                    v = self.p.score.get(parts[i] + parts[i + 1])
                    if v is not None and (best is None or v > best):
                        best, at = v, i
                if at < 0:
                    break  # no merge order makes this piece
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            self.split[s] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self.split[s]

    def compatible(self, a: str, b: str) -> bool:
        ok = self.pairs.get((a, b))
        if ok is None:
            if len(self.pairs) >= CACHE:
                self.pairs.clear()
            ok = self.pairs[a, b] = self.stays(a, b)
        return ok

    def stays(self, a: str, b: str) -> bool:
        """Does merging the text of ``a + b`` end in (a, b)?

        Undoes the merges of the two pieces from the last to the first and
        looks whether a merge over the border came earlier.  Runs of space
        marks share one score, so there the text is merged in full.
        """
        if a[-1] == b[0] == SPACE or self.halves(a) is None and len(a) > 1 or self.halves(b) is None and len(b) > 1:
            return self.merged(a + b) == [a, b]
        score = self.p.score
        left, right = a, b
        before, tie = -float("inf"), False  # a border merge wins with a better score, or with this one if tie
        while True:
            v = score.get(left + right)
            if v is not None and (v > before or tie and v == before):
                return False
            x, y = self.halves(left), self.halves(right)
            if x is None and y is None:
                return True
            if y is None or x is not None and score[left] < score[right]:
                before, tie, left = score[left], False, x[1]
            else:
                before, tie, right = score[right], True, y[0]

    def known(self, s: str) -> list[str]:
        """Pieces of a string of vocabulary characters, by backtracking."""
        n, pos, failed = len(s), 0, 0
        out: list[str] = []
        pairs, longest, shorter = self.pairs, self.p.automaton.iter_long, self.p.shorter
        matches = longest(s)  # the longest piece at pos, then at its end, and so on
        piece, last = next(matches)[1], ""
        while True:
            fresh = piece
            while piece and (failed >> pos + len(piece) & 1 or last and not (pairs.get((last, piece)) or self.compatible(last, piece))):
                piece = shorter[piece]
            if piece:
                out.append(piece)
                pos += len(piece)
                if pos == n:
                    return out
                if piece is not fresh or matches is None:
                    matches = longest(s, pos)
                last, piece = piece, next(matches)[1]
            else:
                failed |= 1 << pos
                pos -= len(last)
                piece = shorter[out.pop()]
                last = out[-1] if out else ""
                matches = None

    def __missing__(self, chunk: str) -> bytes:
        p = self.p
        if chunk[-1] in p.ends and len(chunk) > 1 and (y := chunk[-2]).isascii() and y.isalpha():
            return self[chunk[:-1]] + self[chunk[-1]]
        elif p.chars.issuperset(chunk):
            out = b"".join(map(p.packed.__getitem__, self.known(chunk)))
        else:
            parts = []
            for inside, run in itertools.groupby(chunk, p.chars.__contains__):
                if inside:
                    parts += map(p.packed.__getitem__, self.known("".join(run)))
                else:
                    parts += [array("i", [p.bytes[b] for b in c.encode()] if p.bytes else [p.unk]).tobytes() for c in run]
            out = b"".join(parts)
        if len(chunk) <= 64:
            if len(self) >= CACHE:
                self.clear()
            self[chunk] = out
        return out

    def parts(self, text: str) -> list[bytes]:
        """The ids of each chunk."""
        return list(map(self.__getitem__, self.p.chunks(SPACE + text.replace(" ", SPACE)))) if text else []

    def encode(self, text: str) -> bytes:
        return b"".join(self.parts(text))


class Decoder(dict):
    """ids -> text, piece by piece; runs of byte ids are read as UTF-8.

    As a dictionary it holds the text of packed chunks; a chunk has whole
    characters only, so chunks can be decoded one by one.
    """

    def __init__(self, pieces: Pieces):
        self.plain = {i: t for i, t in pieces.text.items() if isinstance(t, str)}
        self.byte = {i: t for i, t in pieces.text.items() if isinstance(t, int)}
        self.unk = pieces.unk

    def marked(self, ids) -> str:
        """Text with space marks."""
        try:
            return "".join(map(self.plain.__getitem__, ids))  # no byte ids: the common case
        except KeyError:
            out: list[str] = []
            raw = bytearray()
            for i in ids:
                if i in self.byte:
                    raw.append(self.byte[i])
                    continue
                if raw:
                    out.append(raw.decode("utf-8", "replace"))
                    raw.clear()
                out.append(self.plain.get(i, f"{SPACE}⁇{SPACE}" if i == self.unk else ""))
            if raw:
                out.append(raw.decode("utf-8", "replace"))
            return "".join(out)

    def __missing__(self, chunk: bytes) -> str:
        if len(self) >= CACHE:
            self.clear()
        text = self.marked(memoryview(chunk).cast("i"))
        if len(chunk) <= 128:
            self[chunk] = text
        return text

    @staticmethod
    def plain_text(marked: str) -> str:
        """Without the mark put before the text."""
        return marked.removeprefix(SPACE).replace(SPACE, " ")

    def decode(self, ids) -> str:
        return self.plain_text(self.marked(ids))

    def decode_parts(self, parts: list[bytes]) -> str:
        return self.plain_text("".join(map(self.__getitem__, parts)))


def encode(df: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with ``ids`` array<int>: the whole text encoded."""
    def make():
        enc = Encoder(Pieces(model))

        def run(texts):
            packed = [enc.encode(t) for t in texts]
            values = pa.Array.from_buffers(pa.int32(), sum(map(len, packed)) // 4, [None, pa.py_buffer(b"".join(packed))])
            return [pa.ListArray.from_arrays(spans([len(p) // 4 for p in packed]), values)]
        return run

    return append_columns(df, text, f"{ids} array<int>", make)


def encode_decode(df: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids`` array<int> and ``decoded`` string."""
    def make():
        pieces = Pieces(model)
        enc, dec = Encoder(pieces), Decoder(pieces)

        def run(texts):
            parts = [enc.parts(t) for t in texts]
            packed = [b"".join(p) for p in parts]
            values = pa.Array.from_buffers(pa.int32(), sum(map(len, packed)) // 4, [None, pa.py_buffer(b"".join(packed))])
            back = [dec.decode_parts(p) for p in parts]
            return [pa.ListArray.from_arrays(spans([len(p) // 4 for p in packed]), values), pa.array(back, pa.string())]
        return run

    return append_columns(df, text, "ids array<int>, decoded string", make)


def op4(spark, sf_dir: str, model: str | None = None) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", text_or_empty().alias("text"))
    done = encode_decode(docs, model or tokenizer_file("piece_bpe_32k.model"))
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
