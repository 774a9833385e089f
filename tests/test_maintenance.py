"""Stored state kept up to date: order changes, typo index, distinct bitmaps, landing files, foreign orders."""

from collections import Counter
import datetime as dt
import difflib
import os
import random

from hypothesis import given, settings
from hypothesis import strategies as st
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from queryscope.operators import delta, distinct, etl, typos
from queryscope.operators.typo_index import TypoIndex
from queryscope.plans import nightly
from queryscope.sources import fixtures as fx
from queryscope.sources.external import ExternalSource, SchemaMismatch, read_external
from queryscope.sources.shards import write_daily_shards
from queryscope.streaming import ingest

STAMP = dt.datetime(2024, 1, 16, 2, 0)


@pytest.fixture(scope="module")
def fact(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("fact") / "t")
    etl.to_fact(nightly.build_fact_input(fx.raw_ga4_events(spark, SF001), None, STAMP)[1], None).write.partitionBy("data_date").parquet(path)
    return path


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


# ---------------------------------------------------------------- B6/B7

@pytest.mark.parametrize("seed", [1, 2])
def test_random_order_changes_equal_a_rebuild(spark, fact, tmp_path, seed):
    """Orders that come, go, move to another day or user, or cost something else."""
    r = random.Random(seed)
    rows = [tuple(x) for x in fx.orders(spark, SF001).collect()]
    schema = fx.orders(spark, SF001).schema
    r.shuffle(rows)
    before, after, changed = rows[:-30], list(rows[40:]), [x[1:3] for x in rows[:40] + rows[-30:]]
    for i in r.sample(range(len(after)), 30):
        o = list(after[i])
        changed.append(tuple(o[1:3]))
        o[r.choice([1, 2, 3])] = None
        o = [o[0], o[1] or f"u{3 * r.randint(1, 20)}", o[2] or dt.date(2024, 1, r.randint(1, 31)), o[3], o[4]]
        changed.append(tuple(o[1:3]))
        after[i] = tuple(o)
    changed.append((None, dt.date(2024, 1, 9)))
    t = etl.read_fact(spark, fact)
    a, m = str(tmp_path / "a"), str(tmp_path / "m")
    delta.build_tables(t, spark.createDataFrame(before, schema), a, m)
    now = spark.createDataFrame(after, schema)
    days = delta.apply_order_changes(spark, t, now, spark.createDataFrame(changed, "user_pseudo_id string, order_date date"), a, m)
    assert days
    for path, want in ((a, etl.search_order_attribution(t, now)), (m, etl.search_metrics_from_orders(t, now))):
        got = spark.read.schema(want.schema).parquet(path).select(*want.columns)
        assert Counter(got.collect()) == Counter(want.collect())


def test_one_order_rewrites_only_the_days_it_reaches(spark, fact, tmp_path):
    t, orders = etl.read_fact(spark, fact), fx.orders(spark, SF001)
    a, m = str(tmp_path / "a"), str(tmp_path / "m")
    delta.build_tables(t, orders, a, m)
    old = {**files(a), **files(m)}
    user, day = t.filter("user_pseudo_id is not null").groupBy("user_pseudo_id").agg(F.min("event_date")).orderBy("user_pseudo_id").first()
    late = spark.createDataFrame([(10**9, user, day, 5, 1)], "order_id long, user_pseudo_id string, order_date date, order_value int, product_id long")
    late = late.withColumn("order_value", F.col("order_value").cast("decimal(18,2)"))
    assert delta.apply_order_changes(spark, t, orders.unionByName(late), late.select("user_pseudo_id", "order_date"), a, m) == [day]
    new = {**files(a), **files(m)}
    assert all(new.get(f) == x for f, x in old.items() if f"event_date={day}" not in f)
    assert spark.read.parquet(a).filter("order_id = 1000000000").count() >= 1
    assert delta.apply_order_changes(spark, t, orders, late.select("user_pseudo_id", "order_date").limit(0), a, m) == []


def test_the_nightly_mart_is_the_checked_one(spark, tmp_path):
    raw, orders, day = fx.raw_ga4_events(spark, SF001), fx.orders(spark, SF001), dt.date(2024, 1, 15)
    out = nightly.run_nightly(spark, raw, orders, str(tmp_path / "f"), day + dt.timedelta(days=1), STAMP)
    import __spark_entry__ as E
    want = E.queries()["search_metrics_daily"](spark, SF001).filter(F.col("event_date") == F.lit(day))
    got = out["metrics_daily"].select(*want.columns)
    assert Counter(got.collect()) == Counter(want.collect()) and got.count() > 0
    assert Counter(etl.search_metrics_daily(out["attribution"], day).select(*want.columns).collect()) == Counter(want.collect())


# ---------------------------------------------------------------- Z2 index, Z3 short terms

def close(words, cands):
    """By the standard library, whole lists."""
    out = {}
    for w in set(words):
        m = difflib.get_close_matches(w, sorted(set(cands)), n=3, cutoff=0.6)
        if m:
            out[w] = (m[0], m[1:] or None, words.count(w))
    return out


def terms(spark, values):
    return spark.createDataFrame([(v,) for v in values], "search_term string")


def test_nights_equal_one_run_and_compare_new_terms_only(spark, tmp_path):
    r = random.Random(4)
    pool = ["".join(r.choice("abcde ") for _ in range(r.randint(0, 9))) for _ in range(160)] + ["", "laptop", "laptpo", "labtop", "é 😀x"]
    nights = [([r.choice(pool) for _ in range(60)], [r.choice(pool) for _ in range(60)]) for _ in range(2)]
    nights += [([], [""]), ([None, "laptpo", "laptpo"], [None, "laptop"]), ([], [])]
    index, words, cands, compared = TypoIndex(spark, str(tmp_path / "i")), [], [], []
    for i, (w, c) in enumerate(nights):
        compared.append(index.add_night(i, terms(spark, w), terms(spark, c)))
        words += [x.lower() for x in w if x is not None]
        cands += [x.lower() for x in c if x is not None]
        got = {x[0]: tuple(x)[1:] for x in index.suggestions().collect()}
        assert got == close(words, cands)
    assert compared[3] < compared[0] / 3 and compared[4] == 0
    index.add_night(3, terms(spark, nights[3][0]), terms(spark, nights[3][1]))  # a night run again
    assert {x[0]: tuple(x)[1:] for x in index.suggestions().collect()} == close(words, cands)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("k", [0, 1, 2])
def test_levenshtein_pairs_of_short_and_long_terms(spark, k):
    r = random.Random(k)
    some = sorted({"".join(r.choice("abc") for _ in range(r.randint(0, 13))) for _ in range(150)} | {"", "a", "ab"})
    words, cands = some[::2], some[1::2] + ["", "ab"]
    cands = sorted(set(cands))
    got = typos.levenshtein_pairs(spark.createDataFrame([(w,) for w in words], "word string"),
                                  spark.createDataFrame([(c,) for c in cands], "candidate string"), k)
    want = {(w, c, edits(w, c)) for w in words for c in cands if edits(w, c) <= k}
    assert sorted(map(tuple, got.collect())) == sorted(want)


# ---------------------------------------------------------------- distinct counts

@settings(max_examples=6, deadline=None)
@given(st.integers(0, 10**6))
def test_bitmaps_count_any_range_exactly(spark, seed):
    r = random.Random(seed)
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i)
    rows = [(r.choice(["a", "b", None]), day(r.randint(0, 12)), r.choice([None, *(f"u{i}" for i in range(40))])) for _ in range(200)]
    rows += [("a", day(20 + i // 20000), f"x{i}") for i in range(40000)] if seed % 2 else []  # more than one bucket
    ev = spark.createDataFrame(rows, "g string, day date, user string")
    first = distinct.numbered(ev.filter(F.col("day") < day(5)).select("user"))
    ids = distinct.numbered(ev.select("user"), typos.materialize(first, "ids"))
    numbers = sorted(x.id for x in ids.collect())
    assert numbers == list(range(1, len({u for *_, u in rows if u is not None}) + 1))
    bitmaps = typos.materialize(distinct.daily_bitmaps(ev, ids, "user", "day", ["g"]), "bitmaps")
    lo = r.randint(0, 22)
    hi = r.randint(lo, 23)
    want = Counter(g for g, _ in {(g, u) for g, d, u in rows if u is not None and day(lo) <= d <= day(hi)})
    assert {x.g: x.n for x in distinct.distinct_between(bitmaps, "day", day(lo), day(hi), ["g"]).collect()} == want
    got = {(x.window_days, x.end_date): x.n for x in distinct.distinct_in_trailing_days(bitmaps, "day", [1, 3]).collect()}
    ends = {d for _, d, u in rows if u is not None}
    assert got == {(w, e): len({u for _, d, u in rows if u is not None and e - dt.timedelta(days=w - 1) <= d <= e}) for w in (1, 3) for e in ends}


# ---------------------------------------------------------------- B4, B5

def test_a_batch_opens_only_the_folders_of_its_days(spark, tmp_path):
    raw, landing = fx.raw_ga4_events(spark, SF001), str(tmp_path / "landing x")
    day = dt.date(2024, 1, 15)
    write_daily_shards(raw.filter(F.col("event_date") == F.lit(day)), landing)
    alone = set(ingest.landed_days(spark, landing, [day]).inputFiles())
    write_daily_shards(raw.filter(F.col("event_date") != F.lit(day)), landing)   # all the history
    assert set(ingest.landed_days(spark, landing, [day]).inputFiles()) == alone
    write_daily_shards(raw.filter(F.col("event_date") == F.lit(day)).limit(3), landing, "append")
    assert alone < set(ingest.landed_days(spark, landing, [day]).inputFiles())
    assert ingest.landed_days(spark, landing, [day]).count() == raw.filter(F.col("event_date") == F.lit(day)).count() + 3
    raw.limit(2).write.parquet(f"{landing}/other")                               # may hold any day
    assert len(ingest.landed_days(spark, landing, [dt.date(2030, 1, 1)]).inputFiles()) == len(spark.read.parquet(f"{landing}/other").inputFiles())


def test_expiry_reads_no_data(spark, tmp_path):
    for day in ("2023-12-27", "2023-12-28", "2025-01-01"):
        os.makedirs(tmp_path / f"data_date={day}")
        (tmp_path / f"data_date={day}" / "part-0.parquet").write_bytes(b"not a parquet file")
    assert etl.expire_partitions(spark, str(tmp_path), dt.date(2025, 1, 28)) == [dt.date(2023, 12, 27)]
    assert sorted(os.listdir(tmp_path)) == ["data_date=2023-12-28", "data_date=2025-01-01"]
    assert etl.expire_partitions(spark, str(tmp_path), dt.date(2025, 3, 31), months=1) == [dt.date(2023, 12, 28), dt.date(2025, 1, 1)]


# ---------------------------------------------------------------- A5

def external(spark, tmp_path, text, **columns):
    (tmp_path / "o.csv").write_text(text)
    names = {"order_id": "No", "user_pseudo_id": "Buyer", "order_date": "to_date(Day, 'dd.MM.yyyy')", "order_value": "translate(Total, ',', '.')",
             "product_id": "Item", **columns}
    return read_external(spark, ExternalSource("csv", str(tmp_path / "o.csv"), {"sep": ";", "header": "true"}, names))


def test_foreign_orders_are_mapped_and_checked(spark, tmp_path):
    head = "No;Buyer;Day;Total;Item\n"
    rows = external(spark, tmp_path, head + "1;u3;05.01.2024;12,50;7\n2;;06.01.2024;;\n").collect()
    assert [(r.order_id, r.user_pseudo_id, str(r.order_date), r.order_value and str(r.order_value), r.product_id) for r in rows] == [
        (1, "u3", "2024-01-05", "12.50", 7), (2, None, "2024-01-06", None, None)]
    with pytest.raises(SchemaMismatch, match="product_id"):
        read_external(spark, ExternalSource("csv", str(tmp_path / "o.csv"), {"sep": ";", "header": "true"},
                                            {"order_id": "No", "user_pseudo_id": "Buyer", "order_date": "Day", "order_value": "Total"}))
    for bad, column in (("x;u3;05.01.2024;1;7\n", "order_id"), (";u3;05.01.2024;1;7\n", "order_id"), ("1;u3;05.01.2024;much;7\n", "order_value")):
        with pytest.raises(Exception, match=column):
            external(spark, tmp_path, head + bad).collect()


def test_foreign_orders_keep_pruning(spark, tmp_path):
    fx.orders(spark, SF001).write.parquet(str(tmp_path / "p"))
    df = read_external(spark, ExternalSource("parquet", str(tmp_path / "p"))).select("order_id").filter(F.col("order_id") > 5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<order_id:bigint>" in plan
