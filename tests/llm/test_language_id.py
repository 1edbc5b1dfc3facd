"""Language models: they are distributions, they tell held-out texts apart, they reject what is no language."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rentscope.llm import language_id as li
from tests.llm.cases import by_id, edge_documents, no_documents


def test_probabilities_sum_to_one():
    words = {"abba": 3, "ab": 5, "bac": 1, "cab": 2, "a": 4, "caab": 1}
    events: dict[str, int] = {}
    for word, n in words.items():
        marked = li.BEGIN + word + li.END
        for i in range(1, len(marked)):
            gram = marked[max(0, i - 2) : i + 1]
            events[gram] = events.get(gram, 0) + n
    found, counts = li.event_counts(li.Counter(words), 3)
    assert dict(zip(found, counts.tolist(), strict=True)) == events
    letters = "abc" + li.END
    models = li.build_models([("x", e, n) for e, n in events.items()], 3)

    def chance(context: str, letter: str) -> float:
        """The probability of a letter, as the difference of two words' scores cannot be taken: by the definition."""
        probability, back_off = li._kneser_ney(events, 3, len(letters))
        weight = 1.0
        while context + letter not in probability:
            if not context:
                return weight * back_off[""] / (len(letters) + 1)
            weight *= back_off.get(context, 1.0)
            context = context[1:]
        return weight * probability[context + letter]

    for context in ["", "a", "b", "c", li.BEGIN, li.BEGIN + "a", "ab", "bb", "zz", "ca"]:
        total = sum(chance(context, x) for x in letters) + chance(context, "?")
        assert total == pytest.approx(1.0)
    for word in ["abba", "cab", "bbb", "zoo", "a"]:
        marked = li.BEGIN + word + li.END
        expected = sum(np.log(chance(marked[max(0, i - 2) : i], marked[i])) for i in range(1, len(marked)))
        assert models.word_scores([word, "ab"])[0, 0] == pytest.approx(expected)


def test_held_out_texts(spark, medium_dir):
    docs = spark.read.parquet(f"{medium_dir}/documents.parquet")
    found = li.identify(docs).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    assert (found["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in found["doc_id"]]).all()
    held = found[found["held_out"]]
    assert len(held) > 200 and (held["lang"] == held["lang_pred"]).mean() > 0.98
    assert found["score"].between(0, 1).all() and found["rejected"].mean() < 0.01


def test_held_out_languages_do_not_matter(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    first = by_id(li.identify(docs).drop("held_out"))
    assert first == by_id(li.identify(docs.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang")))).drop("held_out"))


def test_what_is_no_language_is_rejected(spark, medium_dir):
    docs = spark.read.parquet(f"{medium_dir}/documents.parquet")
    rng = random.Random(3)
    noise = [" ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(9)) for _ in range(60)) for _ in range(5)]
    extra = [(10**6 + i, t) for i, t in enumerate([*noise, "12 34 !!", None])]
    more = spark.createDataFrame([(i, t, None, "s", 1) for i, t in extra], docs.schema)
    kept = {r["doc_id"] for r in li.recognised(docs.union(more)).select("doc_id").collect()}
    assert not kept & {i for i, _ in extra} and len(kept) >= 0.99 * docs.count()


def test_edges(spark):
    df = edge_documents(spark)
    found = li.identify(df)
    assert found.count() == df.count()
    rows = by_id(found)
    assert {k for k, r in rows.items() if r["lang_pred"] == "und"} == {2, 3, 4}
    assert {r["lang_pred"] for r in rows.values()} <= {"en", "de", "und"}
    assert all(rows[k]["score"] == 0 and rows[k]["rejected"] for k in (2, 3, 4))
    assert li.identify(no_documents(spark)).collect() == []
    unlabelled = li.identify(df.withColumn("lang", F.lit(None).cast("string")))
    assert {(r["lang_pred"], r["score"]) for r in unlabelled.collect()} == {("und", 0.0)}


@pytest.mark.parametrize("cache", [40, 4000])
def test_scores_do_not_depend_on_the_cache(monkeypatch, cache):
    rows = [("x", e, 3) for e in (li.BEGIN + "a", "ab", "b" + li.END, "ba")] + [("y", e, 2) for e in (li.BEGIN + "b", "bb", "b" + li.END, "ab")]
    models = li.build_models(rows, 2)
    rng = random.Random(1)
    texts = [" ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    whole = li.Scorer(models).texts(texts)
    monkeypatch.setattr(li, "CACHE_WORDS", cache)
    monkeypatch.setattr(li, "TEXTS_AT_ONCE", 3)
    monkeypatch.setattr(li, "WORDS_AT_ONCE", 2)
    for a, b in zip(whole, li.Scorer(models).texts(texts), strict=True):
        assert (a is None and b is None) or (a[1] == b[1] and np.allclose(a[0], b[0]))


def assert_same_models(found, expected, words):
    assert found.languages == expected.languages
    assert np.allclose(found.word_scores(words), expected.word_scores(words), rtol=0, atol=1e-9)


def test_no_event_is_left_out(spark):
    """A small language of rare events beside hot and very rich ones: as if counted at one place, also over many parts."""
    rng = random.Random(11)

    def text(letters: str, n: int) -> str:
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 8))) for _ in range(n))

    wide = "".join(chr(0x4E00 + i) for i in range(3_000))
    docs = [(i, text("abcdefghij", 300), "hot") for i in range(60)] + [(100 + i, text(wide, 6_500), "wide") for i in range(20)] + [(900, text("klmnopq", 12), "few")]
    df = spark.createDataFrame([(i, t, lang, "s", len(t)) for i, t, lang in docs], "doc_id long, text string, lang string, source string, n_chars long")
    counts: dict[tuple, int] = {}
    for _, t, lang in docs:
        for event, n in zip(*li.event_counts(li.Counter(li.letter_words(t)), li.ORDER), strict=True):
            counts[lang, event] = counts.get((lang, event), 0) + int(n)
    expected = li.build_models([(lang, e, n) for (lang, e), n in counts.items()])
    words = [w for _, t, _ in docs for w in t.split()[:40]] + ["zoo", "aaaa", "kab", "zz漢"]
    assert len(counts) > 500_000
    found = li.learn(df)
    predicted = {r["doc_id"]: r["lang_pred"] for r in li.predict(df, found).collect()}
    assert predicted == {i: lang for i, _, lang in docs}
    assert_same_models(found, expected, words)


def test_parts_do_not_matter(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    whole, parted = li.learn(docs), li.learn(docs, part_cells=20_000)
    assert len(whole.grams.parts) == 1 and len(parted.grams.parts) > li.PARTS_HELD + 1
    first, second = by_id(li.predict(docs, whole)), by_id(li.predict(docs, parted))
    assert first == second


def test_a_large_script_does_not_let_noise_pass(spark, small_dir):
    """Beside a language of 5,000 letters, random Latin letters go as before, and clean documents stay."""
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    rng = random.Random(5)
    common = [chr(0x4E00 + rng.randrange(5_000)) + chr(0x4E00 + rng.randrange(5_000)) for _ in range(4_000)]
    wide = [(2 * 10**6 + i, " ".join("".join(rng.choices(common, k=3)) for _ in range(120)), "zh") for i in range(60)]
    letters = ["abcdefghijklmnopqrstuvwxyz", "etaoinshrdlu"]
    noise = [(10**6 + i, " ".join("".join(rng.choice(letters[i % 2]) for _ in range(7)) for _ in range(80)), None) for i in range(10)]
    more = spark.createDataFrame([(i, t, lang, "s", len(t)) for i, t, lang in wide + noise], docs.schema)
    kept = {r["doc_id"] for r in li.recognised(docs.union(more)).select("doc_id").collect()}
    assert not kept & {i for i, *_ in noise}
    clean = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert len(kept & clean) >= 0.99 * len(clean)


def test_letters_and_their_marks():
    words = li.letter_words
    assert [words(t) for t in ("½ ② ²", "x² ½a", "नमस्ते दुनिया", "Ünder_Score 12", "l'été")] == [[], ["x", "a"], ["नमस्ते", "दुनिया"], ["ünder", "score"], ["l", "été"]]
    import unicodedata

    for c in map(chr, range(0x250)):
        assert bool(words(f"{c}")) == any(unicodedata.category(x)[0] == "L" for x in c.lower())
