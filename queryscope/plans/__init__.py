"""Multi-operator plans: the nightly ETL chain, report bundles, marts, joins."""
