import duckdb

from downfield import queries

from .compare import assert_same


def test_halves_round_in_the_type_of_the_elements(spark, tmp_path):
    """In single precision a product can be a half that it isn't in double precision."""
    duckdb.sql(f"""COPY (SELECT 1::BIGINT AS vec_id, list_transform(range(-400, 400), lambda k: ((k + 0.5) / 1000)::FLOAT) AS embedding
      UNION ALL SELECT 2, [] UNION ALL SELECT 3, NULL) TO '{tmp_path}/embeddings.parquet'""")
    assert_same(spark, queries.QUERIES["list_stringify"], queries.ORACLES["list_stringify"], str(tmp_path))
