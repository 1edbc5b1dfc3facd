"""Documents that try every operator: nulls, empty and long texts, repeated rows, clashing columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "The quick brown fox jumps over the lazy dog while nobody looks. Ein Satz mit Umlauten: äöü ß. "
LONG = " ".join(f"word{i % 977} {i}" for i in range(30_000))


def rows() -> list[tuple]:
    texts = {
        1: PROSE * 3,
        2: None,
        3: "",
        4: " \t\n\x0b\f\r ",
        5: LONG,
        6: PROSE * 3 + "One more sentence at the very end of it.",
        7: "one",
        8: "two words",
        9: "    no-break space and \x1c control \x00 signs",
        10: "漢字かな交じり文 😀 emoji <|endoftext|> special <s> </s> <unk> \u0558\u0558 \u058b.",
        11: "a" * 5000,
        12: PROSE * 3,
        13: LONG[:100_000],
    }
    out = [(i, t, ["en", "de", None][i % 3], ["s1", None, "s2"][i % 3], None if t is None else len(t)) for i, t in texts.items()]
    out += [out[0], out[0], (None, "no id here, but some words", "en", "s1", 26), (None, None, None, None, None)]
    return out


#: Names that operators use inside or return, and another spelling of one that they read.
CLASHING = ["TEXT", "size", "key", "n", "part", "block", "rep", "score", "features", "packed", "component_id", "n_tokens", "held_out", "lang_pred", "doc"]


def edge_documents(spark: SparkSession, clashing: bool = True) -> DataFrame:
    df = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    spark.conf.set("spark.sql.caseSensitive", "true")
    if clashing:
        df = df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHING)])
    spark.conf.set("spark.sql.caseSensitive", "false")
    return df


def no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def by_id(df: DataFrame, key: str = "doc_id") -> dict:
    """Rows by id; repeated ids must agree."""
    out: dict = {}
    for row in df.collect():
        values = row.asDict()
        if values[key] is not None:
            assert out.setdefault(values[key], values) == values
    return out
