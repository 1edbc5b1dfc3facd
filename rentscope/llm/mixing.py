"""Mixing sources to target weights.

Documents get hash-random keys. Within each source they are ordered by key, in buckets of
equal key width; word counts are summed per bucket, prefix sums of the buckets are taken
over the small bucket table, and rows are ordered within their bucket only. So a source
that holds most of the rows is spread over thousands of small groups. Each source is cut
at its exact budget of words, after as many whole epochs as the budget covers.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from rentscope.llm.common import DOCUMENT_COLUMNS, pick
from rentscope.plans.saved import save

#: A run of these is a word: anything but space, tab, line feed, vertical tab, form feed and return.
WORD = "[^ \\t\\n\\x0B\\f\\r]+"
WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
SEED = "mix"
#: Hex digits of the key that name a bucket: 3 make 4,096 buckets per source.
BUCKET_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix_key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))))


def source_budgets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most_epochs: int = MOST_EPOCHS, share: float = 1.0) -> DataFrame:
    """One row per source: ``source, source_size, target, budget``.

    Sources by code point, null last, take ``weights`` in turn. Together they get ``share`` of
    all words; a source stops at ``most_epochs`` times its size and the excess goes to the rest
    by weight. The common level per unit of weight is the first one, in order of the ratio at
    which sources fill up, that the next source does not reach. One row per source is ordered.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    fill = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    caps = (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * most_epochs)
        .withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
    )
    filled = (
        caps.withColumn("turn", F.row_number().over(fill))
        .withColumn("before", F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("rest", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("total", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("level", (F.col("total") * share - F.col("before")).cast("double") / F.col("rest"))
        .withColumn("common", F.min_by("level", F.when(F.col("level") <= F.col("ratio"), F.col("turn"))).over(Window.partitionBy()))
    )
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("common") * F.col("weight"), F.col("cap").cast("double")))
    return filled.select("source", "source_size", target.alias("target"), F.floor(target + 0.5).cast("long").alias("budget"))


def _digest(*columns: str) -> Column:
    """Rows of equal values, and no others, share it; each value goes in with its length."""
    texts = [F.col(c).cast("string") for c in columns]
    return F.md5(F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def _contents() -> Column:
    """The order among rows of one key and size: id and text first, which ``mix`` reads too."""
    return F.concat(_digest("doc_id", "text"), _digest("lang", "n_chars"))


def _keyed(docs: DataFrame, seed: str, content: Column) -> DataFrame:
    """Key, size and content of each document; the texts are read once and go no further."""
    return save(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), mix_key(F.col("doc_id"), seed).alias("key"), content.alias("content")), "mix-sizes")


def _before(counted: DataFrame, order: Sequence[str], value: Column, digits: int) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over a source's rows that come first in ``order``, whose first column names buckets."""
    counted = counted.withColumn("value", value).withColumn("bucket", F.substring(order[0], 1, digits))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        counted.groupBy("source", "bucket").agg(F.sum("value").alias("bucket_value"))
        .select(F.col("source").alias("of"), F.col("bucket").alias("at"), F.coalesce(F.sum("bucket_value").over(ahead), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("source", "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        counted.join(buckets, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("at")))
        .withColumn("before", F.col("offset") + F.coalesce(F.sum("value").over(inside), F.lit(0)))
        .drop("of", "at", "offset", "bucket", "value")
    )


def _cuts(keyed: DataFrame, budgets: DataFrame, digits: int) -> DataFrame:
    """One row per source: ``of, source_size, target, epochs, cut_key, cut_size, cut_content, cut_whole, cut_words``.

    What is before the cut's key, size and content comes once more than the epochs. Of the rows that
    equal all three, ``cut_whole`` do, and one more with its first ``cut_words`` words. The cut is null
    where nothing is left after the epochs.
    """
    groups = keyed.filter("size > 0").groupBy("source", "key", "size").agg(F.count(F.lit(1)).alias("n"))
    named = budgets.select(F.col("source").alias("named"), (F.col("budget") - _epochs() * F.col("source_size")).alias("rest"))
    crossed = (
        _before(groups, ["key", "size"], F.col("size") * F.col("n"), digits)
        .join(named, F.col("source").eqNullSafe(F.col("named")))
        .filter((F.col("before") < F.col("rest")) & (F.col("before") + F.col("size") * F.col("n") >= F.col("rest")))
        .select(F.col("source").alias("of"), F.col("key").alias("cut_key"), F.col("size").alias("cut_size"), (F.col("rest") - F.col("before")).alias("left"))
    )
    crossed = save(crossed, "mix-crossed")
    at_cut = F.col("source").eqNullSafe(F.col("of")) & (F.col("key") == F.col("cut_key")) & (F.col("size") == F.col("cut_size"))
    contents = keyed.join(F.broadcast(crossed), at_cut, "left_semi").groupBy("source", "content").agg(F.count(F.lit(1)).alias("n"))
    words = F.col("left") - F.col("before") * F.col("cut_size")
    exact = (
        _before(contents, ["content"], F.col("n"), digits)
        .join(F.broadcast(crossed), F.col("source").eqNullSafe(F.col("of")))
        .filter((words > 0) & (words <= F.col("n") * F.col("cut_size")))
        .select("of", "cut_key", "cut_size", F.col("content").alias("cut_content"), F.expr("CAST((left - before * cut_size - 1) div cut_size AS BIGINT)").alias("cut_whole"), words.alias("words"))
        .withColumn("cut_words", F.col("words") - F.col("cut_whole") * F.col("cut_size"))
        .drop("words")
    )
    whole = budgets.select(F.col("source").alias("named"), "source_size", "target", _epochs().alias("epochs"))
    cuts = whole.join(exact, F.col("named").eqNullSafe(F.col("of")), "left").drop("of").withColumnRenamed("named", "of")
    return save(cuts, "mix-cuts")


def _ahead() -> Column:
    """Whether a row comes before its source's cut; false where there is none, null never."""
    first = (F.col("key") < F.col("cut_key")) | ((F.col("key") == F.col("cut_key")) & (
        (F.col("size") < F.col("cut_size")) | ((F.col("size") == F.col("cut_size")) & (F.col("content") < F.col("cut_content")))))
    return F.coalesce(first, F.lit(False))


def _at_cut() -> Column:
    return F.coalesce((F.col("key") == F.col("cut_key")) & (F.col("size") == F.col("cut_size")) & (F.col("content") == F.col("cut_content")), F.lit(False))


def _epochs() -> Column:
    return F.expr("CASE WHEN source_size > 0 THEN budget div source_size ELSE 0L END")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most_epochs: int = MOST_EPOCHS, share: float = 1.0, seed: str = SEED, bucket_digits: int = BUCKET_DIGITS) -> DataFrame:
    """How many words the mix takes of each document.

    Returns ``doc_id, size, source_size, target, taken, source``, one row per input row. Null
    texts have size 0; null is a source of its own; rows that share an id, or have none, share a
    key and go by size and then by content. Repeated rows are taken one after the other. An empty table gives an empty result.
    """
    docs = pick(docs, "doc_id", "text", "source")
    keyed = _keyed(docs, seed, _digest("doc_id", "text"))
    cuts = _cuts(keyed, source_budgets(keyed, weights, most_epochs, share), bucket_digits)
    placed = keyed.join(F.broadcast(cuts), F.col("source").eqNullSafe(F.col("of")))
    names = ["doc_id", "source", "size", "source_size", "target"]
    once = F.when(_ahead(), F.col("size")).otherwise(0)
    apart = placed.filter(~_at_cut()).select(*names, (F.col("epochs") * F.col("size") + once).alias("taken"))
    # Rows that equal the one at the cut in id and text are counted and told apart by number.
    equal = placed.filter(_at_cut()).groupBy(*names, "epochs", "cut_whole", "cut_words").agg(F.count(F.lit(1)).alias("n"))
    equal = equal.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    last = F.when(F.col("turn") < F.col("cut_whole"), F.col("size")).when(F.col("turn") == F.col("cut_whole"), F.col("cut_words")).otherwise(0)
    taken = apart.unionByName(equal.select(*names, (F.col("epochs") * F.col("size") + last).alias("taken")))
    return taken.select("doc_id", "size", "source_size", "target", "taken", "source")


@F.pandas_udf(StringType())
def _first_words(texts: pd.Series, counts: pd.Series) -> pd.Series:
    """Each text up to the end of its n-th word."""
    import itertools
    import re

    def cut(text: str, n: int) -> str:
        end = 0
        for word in itertools.islice(re.finditer(r"[^\x20\x09-\x0D]+", text), n):
            end = word.end()
        return text[:end]

    return pd.Series([cut(t, int(n)) for t, n in zip(texts, counts, strict=True)])


def mixed_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most_epochs: int = MOST_EPOCHS, share: float = 1.0, seed: str = SEED, bucket_digits: int = BUCKET_DIGITS) -> DataFrame:
    """The mix itself, with the columns of ``documents``.

    A document comes once per epoch taken of it; the one at the cut comes with its first words
    up to the budget, and its ``n_chars`` follows. Cuts are one row per source, so texts are
    filtered in place; only rows equal in every column to the one at the cut are reduced to one
    per source, which is then repeated. Documents without words belong to each epoch and, by key, to the
    part before the cut.
    """
    docs = pick(docs, *DOCUMENT_COLUMNS)
    keyed = _keyed(docs, seed, _contents())
    cuts = _cuts(keyed, source_budgets(keyed, weights, most_epochs, share), bucket_digits)
    # Only at a cut's key is there more to compare than the key.
    joined = docs.withColumn("key", mix_key(F.col("doc_id"), seed)).join(F.broadcast(cuts), F.col("source").eqNullSafe(F.col("of")))
    near = F.col("key") == F.col("cut_key")
    joined = joined.withColumn("size", F.when(near, word_count(F.col("text")))).withColumn("content", F.when(near, _contents()))
    copies = F.col("epochs") + F.when(_ahead(), 1).otherwise(0)
    whole = joined.withColumn("copies", copies.cast("int")).filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    equal = joined.filter(_at_cut()).groupBy("source", "cut_whole", "cut_words").agg(*[F.first(c).alias(c) for c in DOCUMENT_COLUMNS if c != "source"])
    again = equal.filter("cut_whole > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("cut_whole"))))
    part = equal.withColumn("text", _first_words(F.coalesce("text", F.lit("")), "cut_words"))
    part = part.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return whole.select(*DOCUMENT_COLUMNS).unionByName(again.select(*DOCUMENT_COLUMNS)).unionByName(part.select(*DOCUMENT_COLUMNS))


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents),
named AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight
  FROM sized GROUP BY source),
-- water filling by trial: a source is full if even the level at which it fills up needs no more than all words
levels AS (
  SELECT a.source, a.source_size, a.weight, a.source_size * 3.0::DOUBLE / a.weight AS ratio,
    (SELECT sum(least(b.source_size * 3.0::DOUBLE, b.weight * (a.source_size * 3.0::DOUBLE / a.weight))) FROM named b)
      < (SELECT sum(source_size) FROM named) AS is_full
  FROM named a),
common AS (
  SELECT ((SELECT sum(source_size) FROM named) - coalesce(sum(CASE WHEN is_full THEN 3 * source_size END), 0))::DOUBLE
    / sum(CASE WHEN NOT is_full THEN weight END) AS level FROM levels),
targets AS (
  SELECT l.source, source_size, CASE WHEN is_full THEN 3.0::DOUBLE * source_size ELSE least(level * weight, 3.0::DOUBLE * source_size) END AS target
  FROM levels l, common),
budgets AS (
  SELECT source, source_size, target, CAST(floor(target + 0.5) AS BIGINT) AS budget FROM targets),
placed AS (
  SELECT s.doc_id, s.source, s.size, b.source_size, b.target, b.budget,
    CASE WHEN b.source_size > 0 THEN b.budget // b.source_size ELSE 0 END AS epochs,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, source, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS taken
FROM placed
"""
