"""The driver contract of ``__spark_entry__``."""
import duckdb

import __spark_entry__ as E
from souk.plans import registry
from conftest import SF_SMALL


def test_entry_runs_with_stable_schema(spark):
    df = E.entry(spark)
    assert df.schema.simpleString() == "struct<region:string,n_offers:bigint,n_cities:bigint,sum_quality:bigint>"
    assert df.count() > 0


def test_every_query_has_oracle_sql_that_binds():
    qs, sqls = E.queries(), E.oracle_sql()
    own = registry.spark_queries()
    assert set(own) <= set(qs) and set(own) == set(registry.oracle_queries()) and set(sqls) <= set(qs) and len(own) == 47
    con = duckdb.connect()
    for t in ("documents", "pages", "orders", "customer", "nation", "benchmark", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for key, sql in sqls.items():
        assert con.sql(sql).columns, key  # parses and binds
