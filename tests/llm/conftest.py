import pytest
from pyspark.sql import functions as F

# Columns with names that the operators use themselves, as a caller's table may have them.
CLASHES = (
    "file row content place digest keep text_sha256 group_size token grp cls label block ids idx word found base "
    "spans copies size target source_size draw rate own copy _maybe _bit _bucket _members n at prefix pivot score "
    "component stays follower mentions key count lang_pred "
    "pos hash item path top leaf held_out chunks entry code error slot"
).split()


@pytest.fixture
def stored(spark, tmp_path):
    """A stored table of the given rows with further columns of clashing names."""

    def store(rows, schema="doc_id bigint, text string", files=2, name="documents"):
        df = spark.createDataFrame(rows, schema)
        df = df.select("*", *(F.lit(c).alias(c) for c in CLASHES if c not in df.columns))
        path = f"{tmp_path}/{name}.parquet"
        df.repartition(files).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return store


@pytest.fixture
def by_id():
    """Rows by their first column, all ids being different."""

    def index(df):
        rows = df.collect()
        found = {r[0]: r for r in rows}
        assert len(found) == len(rows)
        return found

    return index


ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
