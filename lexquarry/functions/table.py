"""Table functions for SQL: ``SELECT * FROM chunk_text(TABLE(docs) PARTITION BY id)``."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from lexquarry.functions.text import split_chunks


class ChunkText:
    """Rows of a table with a text column as rows of its chunks, beside the table's other columns.

    ``analyze`` makes the result's columns of the table's own: those but the text, then chunk_index, content
    and word_count. The text column is ``content`` unless ``text_col`` names another; a table without it is an
    error when the query is analysed, not when it runs. A null text has no chunks.
    """

    @staticmethod
    def analyze(rows: AnalyzeArgument, text_col: AnalyzeArgument | None = None, target: AnalyzeArgument | None = None, overlap: AnalyzeArgument | None = None, min_words: AnalyzeArgument | None = None) -> AnalyzeResult:
        if not rows.isTable:
            raise ValueError("the first argument of chunk_text is a table: chunk_text(TABLE(docs))")
        name = text_col.value if text_col is not None else "content"
        fields = {f.name: f for f in rows.dataType.fields}
        if name not in fields or not isinstance(fields[name].dataType, T.StringType):
            raise ValueError(f"the table has no text column {name}; it has {', '.join(fields)}")
        added = {"chunk_index": T.IntegerType(), "content": T.StringType(), "word_count": T.LongType()}
        kept = [f for f in rows.dataType.fields if f.name != name]
        if clash := [f.name for f in kept if f.name.lower() in added]:
            raise ValueError(f"the table has columns of the result: {', '.join(clash)}")
        return AnalyzeResult(schema=T.StructType([*kept, *[T.StructField(k, v) for k, v in added.items()]]))

    def eval(self, rows: Row, text_col: str = "content", target: int = 500, overlap: int = 50, min_words: int = 100) -> Iterator[tuple]:
        others = tuple(rows[f] for f in rows.__fields__ if f != text_col)
        for i, chunk in enumerate(split_chunks(rows[text_col] or "", target, overlap, min_words)):
            yield (*others, i, chunk, len(chunk.split()))


def register(spark: SparkSession) -> None:
    """Makes ``chunk_text`` known to the session's SQL."""
    spark.udtf.register("chunk_text", udtf(ChunkText))
