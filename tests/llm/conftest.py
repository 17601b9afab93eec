import pytest
from pyspark.sql import functions as F

from beaconlake.llm.common import prepared

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, row long, key string, size int"


@pytest.fixture
def docs(spark):
    """Documents from (id, text) or (id, text, lang, source), with extra columns whose names clash."""
    prepared(spark)

    def make(*rows):
        full = [(*r, *[None] * (4 - len(r)))[:4] for r in rows]
        frame = spark.createDataFrame(full, "doc_id long, text string, lang string, source string")
        frame = frame.withColumns({"n_chars": F.length("text").cast("long"), "score": F.lit("x"), "row": F.lit(7), "key": F.lit("k"), "size": F.lit(3)})
        return frame.select("doc_id", "text", "lang", "source", "n_chars", "score", "row", "key", "size")

    return make
