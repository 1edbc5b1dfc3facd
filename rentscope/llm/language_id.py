"""Language identification by interpolated Kneser-Ney character models.

One model per language over the letters of words, with marks for word begin and end; a
context never reaches past its word. Events (a letter and the letters before it) are counted
over all rows to learn from, as sums per task and then per language. Continuation counts,
context totals and discounts are grouped sums over all events, and probabilities are joined
up from the shorter n-grams; nothing is left out. The models are arrays sorted by n-gram hash
with one column of log probabilities or back-off weights per language, dealt over parts of
bounded size: the driver makes one part at a time, and a task that meets more parts than it
may hold reads the others again. A text gets the language of lowest
cross-entropy per letter. It is rejected where that exceeds what texts of its length in that
language show, by a margin calibrated on the labelled texts; mixtures of languages stay.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import batched, chain

import numpy as np
import regex
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from rentscope.llm.common import DOCUMENT_COLUMNS, fold, map_batches, pick, smaller_batches, worker_state
from rentscope.plans.saved import save

UNDETERMINED = "und"
ORDER = 4
#: Numbers (rows times languages) in a part of the models, and parts of a table that a worker keeps; others are read when needed.
PART_CELLS = 2_000_000
PARTS_HELD = 2
#: Distinct words a task holds before it sends their counts on.
WORDS_HELD = 200_000
#: Words whose scores a worker keeps, texts that are looked up together, and new words that are scored together.
CACHE_WORDS = 150_000
TEXTS_AT_ONCE = 250
WORDS_AT_ONCE = 5_000
#: Rejection: this share of the way from the language's own mean to its own letters drawn one by one, and so many standard errors over the text's letters above it.
MARGIN, STANDARD_ERRORS = 0.5, 5.0

BEGIN, END = "\x02", "\x03"
#: A word is letters and the marks on them. Up to U+024F every word character is a letter but digits, the underscore and a few numbers.
LATIN = re.compile("[\x00-\u024f]*").fullmatch
LATIN_WORDS = re.compile("[^\\W\\d_\u00b2\u00b3\u00b9\u00bc-\u00be]+").findall
WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*").findall
# Odd multipliers by distance from the end of an n-gram.
_FACTORS = np.random.default_rng(20240229).integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def letter_words(text: str) -> list[str]:
    text = text.lower()
    return LATIN_WORDS(text) if LATIN(text) else WORDS(text)


def _events(words: list[str], order: int) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """The marked words in one string, and for each event its word, its end in the string and its length."""
    marked = BEGIN + (END + BEGIN).join(words) + END
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(lengths) - lengths
    word = np.repeat(np.arange(len(words)), lengths - 1)
    place = np.arange(len(word)) - np.repeat(np.cumsum(lengths - 1) - (lengths - 1), lengths - 1) + 1
    return marked, word, starts[word] + place, np.minimum(place + 1, order)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)


def _hashes(codes: np.ndarray, ends: np.ndarray, lengths: np.ndarray, order: int) -> list[np.ndarray]:
    """For k = 1..order the hash of the n-gram of k letters that ends at each event, 0 where the word has fewer."""
    found, total = [], np.zeros(len(ends), np.uint64)
    for k in range(1, order + 1):
        total = total + codes[np.maximum(ends - k + 1, 0)] * _FACTORS[k - 1] * (lengths >= k)
        found.append(np.where(lengths >= k, total, np.uint64(0)))
    return found


def ngram_hash(ngrams: list[str]) -> np.ndarray:
    """Hashes of n-grams given as strings, as ``_hashes`` makes them."""
    total = np.zeros(len(ngrams), np.uint64)
    sizes = np.fromiter(map(len, ngrams), np.int64, len(ngrams))
    codes, ends = _codes("".join(ngrams)), np.cumsum(sizes) - 1
    for k in range(1, int(sizes.max(initial=0)) + 1):
        total = total + codes[np.maximum(ends - k + 1, 0)] * _FACTORS[k - 1] * (sizes >= k)
    return total


def event_counts(words: Counter[str], order: int) -> tuple[list[str], np.ndarray]:
    """Distinct events of counted words, as strings, with how often they occur."""
    names = list(words)
    if not names:
        return [], np.zeros(0, np.int64)
    marked, word, ends, lengths = _events(names, order)
    full = np.take_along_axis(np.stack(_hashes(_codes(marked), ends, lengths, order)), (lengths - 1)[None, :], 0)[0]
    _, first, group = np.unique(full, return_index=True, return_inverse=True)
    counts = np.bincount(group, weights=np.fromiter(words.values(), np.float64, len(names))[word]).astype(np.int64)
    return [marked[e - n + 1 : e + 1] for e, n in zip(ends[first].tolist(), lengths[first].tolist(), strict=True)], counts


def count_events(labelled: DataFrame, order: int = ORDER) -> DataFrame:
    """``lang, event, n`` over all labelled texts: summed per task first, then shuffled by event."""
    schema = StructType([StructField("lang", StringType()), StructField("event", StringType()), StructField("n", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter[str]] = defaultdict(Counter)

        def sums() -> Iterator[pa.RecordBatch]:
            for lang, words in held.items():
                events, counts = event_counts(words, order)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(events), pa.string()), pa.array(events, pa.string()), pa.array(counts)], names=schema.names)
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                held[lang].update(letter_words(text))
                if sum(map(len, held.values())) > WORDS_HELD:
                    yield from sums()
        yield from sums()

    smaller_batches(labelled.sparkSession)
    return labelled.select("lang", "text").mapInArrow(run, schema).groupBy("lang", "event").agg(F.sum("n").alias("n"))


def _kneser_ney(events: dict[str, int], order: int, alphabet: int) -> tuple[dict[str, float], dict[str, float]]:
    """Interpolated probabilities of all n-grams and back-off weights of all contexts of one language."""
    counts: list[dict[str, int]] = [{} for _ in range(order + 1)]
    for event, n in events.items():
        counts[len(event)][event] = n
    for k in range(order, 1, -1):
        # An n-gram that starts a word has nothing before it: its count stays. Others count the different letters before them.
        for gram in counts[k]:
            if len(gram) > 1:
                counts[k - 1][gram[1:]] = counts[k - 1].get(gram[1:], 0) + 1
    probability: dict[str, float] = {}
    back_off: dict[str, float] = {}
    for k in range(1, order + 1):
        values = Counter(counts[k].values())
        discount = values[1] / (values[1] + 2 * values[2]) if values[1] and values[2] else 0.5
        total: dict[str, int] = defaultdict(int)
        kinds: dict[str, int] = defaultdict(int)
        for gram, n in counts[k].items():
            total[gram[:-1]] += n
            kinds[gram[:-1]] += 1
        for context, n in total.items():
            back_off[context] = discount * kinds[context] / n
        for gram, n in counts[k].items():
            lower = probability[gram[1:]] if k > 1 else 1.0 / (alphabet + 1)
            probability[gram] = (n - discount) / total[gram[:-1]] + back_off[gram[:-1]] * lower
    return probability, back_off


class Table:
    """Rows of one number per language by 64-bit key, dealt over parts by the upper half of the key.

    A part is a pair of sorted keys and rows, or a broadcast of one. Up to ``PARTS_HELD`` broadcast
    parts stay in memory once read; the others are read for each search that needs them.
    """

    def __init__(self, parts: list, width: int):
        self.parts = parts
        self.width = width
        self.held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _part(self, at: int) -> tuple[np.ndarray, np.ndarray]:
        part = self.held.get(at, self.parts[at])
        if not isinstance(part, Broadcast):
            return part
        # Not ``value``, which would keep every part that was ever read.
        read = part.load_from_path(part._path)
        if len(self.held) < PARTS_HELD:
            self.held[at] = read
        return read

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are there, and the rows of those that are."""
        found = np.zeros(len(keys), bool)
        rows = np.zeros((len(keys), self.width))
        part = part_of(keys, len(self.parts))
        for at in np.unique(part):
            known, values = self._part(int(at))
            if len(known):
                here = np.flatnonzero(part == at)
                place = np.minimum(np.searchsorted(known, keys[here]), len(known) - 1)
                same = known[place] == keys[here]
                found[here] = same
                rows[here[same]] = values[place[same]]
        return found, rows[found]


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (keys >> np.uint64(32)) % np.uint64(parts)


@dataclass
class Models:
    """All languages' models, one column per language."""

    languages: list[str]
    order: int
    grams: Table
    contexts: Table
    log_unknown: np.ndarray
    #: By language, the entropy of its letters drawn one by one as often as it has them: other languages' letters do not move it, rare ones hardly.
    of_letters: dict[str, float]

    def renew(self, other: Models) -> None:
        """Read parts from where ``other`` has them: a task may not rely on the files of one before it."""
        self.grams.parts, self.contexts.parts = other.grams.parts, other.contexts.parts

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language."""
        marked, word, ends, lengths = _events(words, self.order)
        codes = _codes(marked)
        here = _hashes(codes, ends, lengths, self.order)
        before = _hashes(codes, ends - 1, lengths - 1, self.order)
        scores = np.zeros((len(word), len(self.languages)))
        open_ = np.arange(len(word))
        for k in range(self.order, 0, -1):
            fits = lengths[open_] >= k
            at = open_[fits]
            found, log_p = self.grams.find(here[k - 1][at])
            scores[at[found]] += log_p
            missed = at[~found]
            context = before[k - 2][missed] if k > 1 else np.zeros(len(missed), np.uint64)
            known, log_back_off = self.contexts.find(context)
            scores[missed[known]] += log_back_off
            open_ = np.concatenate([open_[~fits], missed])
        scores[open_] += self.log_unknown
        return np.add.reduceat(scores, np.flatnonzero(np.r_[True, word[1:] != word[:-1]]), axis=0)


def build_models(rows: list[tuple[str, str, int]], order: int = ORDER) -> Models | None:
    """Models from event counts at hand, as ``models_of`` makes them from a table; None without any."""
    by_language: dict[str, dict[str, int]] = defaultdict(dict)
    for lang, event, n in rows:
        by_language[lang][event] = n
    languages = sorted(by_language)
    if not languages:
        return None
    alphabet = len({event[-1] for _, event, _ in rows})
    parts = [_kneser_ney(by_language[lang], order, alphabet) for lang in languages]
    grams = sorted({g for p, _ in parts for g in p}, key=lambda g: (len(g), g))
    contexts = sorted({c for _, b in parts for c in b})
    index = {g: i for i, g in enumerate(grams)}
    log_p = np.zeros((len(grams), len(languages)))
    log_back_off = np.zeros((len(contexts), len(languages)))
    for column, (probability, back_off) in enumerate(parts):
        log_back_off[:, column] = [math.log(back_off.get(c, 1.0)) for c in contexts]
        for i, g in enumerate(grams):
            # What one language has not seen backs off here, so that each n-gram is looked up once for all.
            if g in probability:
                log_p[i, column] = math.log(probability[g])
            else:
                lower = log_p[index[g[1:]], column] if len(g) > 1 else -math.log(alphabet + 1)
                log_p[i, column] = math.log(back_off.get(g[:-1], 1.0)) + lower
    keys, context_keys = ngram_hash(grams), ngram_hash(contexts)
    by_key, by_context = np.argsort(keys), np.argsort(context_keys)
    # The empty context is the one of single letters: its back-off applies once a letter is unknown.
    return Models(
        languages, order, Table([(keys[by_key], log_p[by_key])], len(languages)),
        Table([(context_keys[by_context], log_back_off[by_context])], len(languages)),
        np.full(len(languages), -math.log(alphabet + 1)), {lang: _letter_entropy(by_language[lang]) for lang in languages},
    )


def _letter_entropy(events: dict[str, int]) -> float:
    letters: Counter[str] = Counter()
    for event, n in events.items():
        letters[event[-1]] += n
    total = sum(letters.values())
    return math.log(total) - sum(n * math.log(n) for n in letters.values()) / total


def _gram_counts(events: DataFrame, order: int) -> DataFrame:
    """``lang, gram, k, n``: n-grams of each length with their counts, those of continuations below the longest."""
    level = events.filter(F.length("event") == order).select("lang", F.col("event").alias("gram"), F.lit(order).alias("k"), "n")
    out = level
    for k in range(order - 1, 0, -1):
        # As in ``_kneser_ney``: what starts a word keeps its count, others count the different letters before them.
        after = level.groupBy("lang", F.expr("substring(gram, 2)").alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        begun = events.filter(F.length("event") == k).select("lang", F.col("event").alias("gram"), "n")
        level = begun.unionByName(after).select("lang", "gram", F.lit(k).alias("k"), "n")
        out = out.unionByName(level)
    return out


def _by_language(df: DataFrame, key: list[str], value: str, languages: list[str], missing: float, name: str) -> DataFrame:
    """One row per key with an array of the languages' values."""
    entries = F.map_from_entries(F.collect_list(F.struct("lang", value)))
    row = F.array(*[F.coalesce(F.try_element_at("of", F.lit(lang)), F.lit(missing)) for lang in languages])
    return df.groupBy(*key).agg(entries.alias("of")).select(*key, row.alias(name))


def _broadcast_table(df: DataFrame, text: str, values: str, width: int, part_cells: int) -> Table:
    """The logs of a table's arrays by the hash of their string, as broadcast parts; the driver holds one part at a time."""
    schema = StructType([StructField("hash", LongType()), StructField("row", ArrayType(DoubleType()))])

    def make() -> Callable:
        def step(columns: dict[str, list]) -> dict[str, list]:
            rows = np.log(np.array(columns[values]).reshape(-1, width))
            return {"hash": ngram_hash(columns[text]).view(np.int64), "row": list(rows)}

        return step

    hashed = save(map_batches(df.select(text, values), make, schema), "model")
    n = max(1, math.ceil(hashed.count() * width / part_cells))
    part = F.pmod(F.shiftrightunsigned("hash", 32), F.lit(n))
    parts = []
    for at in range(n):
        rows = hashed.filter(part == at).toArrow()
        keys = rows.column("hash").to_numpy().view(np.uint64)
        numbers = rows.column("row").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        order = np.argsort(keys)
        parts.append(df.sparkSession.sparkContext.broadcast((keys[order], numbers[order])))
    return Table(parts, width)


def models_of(events: DataFrame, order: int = ORDER, part_cells: int = PART_CELLS) -> Models | None:
    """Models from a stored table of event counts (``lang, event, n``), over all of its rows; None without any."""
    languages = sorted(r.lang for r in events.select("lang").distinct().collect())
    if not languages:
        return None
    letters = events.groupBy("lang", F.expr("right(event, 1)").alias("letter")).agg(F.sum("n").alias("n"))
    entropy = F.log(F.sum("n")) - F.sum(F.col("n") * F.log("n")) / F.sum("n")
    of_letters = {r.lang: r.entropy for r in letters.groupBy("lang").agg(entropy.alias("entropy")).collect()}
    grams = save(_gram_counts(events, order), "grams")
    alphabet = grams.filter("k = 1").select("gram").distinct().count()
    ones, twos = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
    discounts = grams.groupBy("lang", "k").agg(F.when((ones > 0) & (twos > 0), ones / (ones + 2 * twos)).otherwise(0.5).alias("discount"))
    grams = grams.join(F.broadcast(discounts), ["lang", "k"]).withColumn("context", F.expr("substring(gram, 1, k - 1)"))
    contexts = save(
        grams.groupBy("lang", "context").agg(F.sum("n").alias("total"), (F.first("discount") * F.count(F.lit(1)) / F.sum("n")).alias("back_off")),
        "contexts",
    )
    own = grams.join(contexts, ["lang", "context"]).withColumn("own", (F.col("n") - F.col("discount")) / F.col("total"))
    own = save(_by_language(own, ["gram", "k", "context"], "own", languages, 0.0, "own"), "own")
    back_offs = save(_by_language(contexts, ["context"], "back_off", languages, 1.0, "back_off"), "back-offs")
    # What one language has not seen backs off here, so that each n-gram is looked up once for all.
    chance = F.zip_with("own", F.zip_with("back_off", "lower", lambda b, x: b * x), lambda a, b: a + b)
    levels: list[DataFrame] = []
    for k in range(1, order + 1):
        here = own.filter(F.col("k") == k).join(back_offs, "context")
        if levels:
            lower = levels[-1].select(F.col("gram").alias("rest"), F.col("chance").alias("lower"))
            here = here.withColumn("rest", F.expr("substring(gram, 2)")).join(lower, "rest")
        else:
            here = here.withColumn("lower", F.array_repeat(F.lit(1.0 / (alphabet + 1)), len(languages)))
        levels.append(save(here.select("gram", chance.alias("chance")), f"chances-{k}"))
    chances = levels[0]
    for level in levels[1:]:
        chances = chances.unionByName(level)
    return Models(
        languages, order, _broadcast_table(chances, "gram", "chance", len(languages), part_cells),
        _broadcast_table(back_offs, "context", "back_off", len(languages), part_cells),
        np.full(len(languages), -math.log(alphabet + 1)), of_letters,
    )


class Scorer:
    """Scores texts word by word; scores of words met before come from two bounded tables, the older behind the newer."""

    def __init__(self, models: Models):
        self.models = models
        self.behind: tuple[dict[str, int], np.ndarray] = {}, np.zeros((0, len(models.languages)))
        self.row: dict[str, int] = {}
        self.table = np.zeros((1024, len(models.languages)))

    def _learn(self, words: list[str]) -> None:
        if len(self.row) + len(words) > CACHE_WORDS:
            self.behind = self.row, self.table
            self.row, self.table = {}, np.zeros((1024, len(self.models.languages)))
        first = len(self.row)
        while first + len(words) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        known, scores = self.behind
        old = [w for w in words if w in known]
        new = [w for w in words if w not in known]
        if old:
            self.table[first : first + len(old)] = scores[[known[w] for w in old]]
        if new:
            at = first + len(old)
            for part in batched(new, WORDS_AT_ONCE):
                self.table[at : at + len(part)] = self.models.word_scores(list(part))
                at += len(part)
        self.row.update(zip(old + new, range(first, first + len(words)), strict=True))

    def texts(self, texts: list[str | None]) -> list[tuple[np.ndarray, int] | None]:
        """Log probability by language and number of events of each text; None without a letter."""
        out: list[tuple[np.ndarray, int] | None] = []
        for at in range(0, len(texts), TEXTS_AT_ONCE):
            words = [letter_words(t or "") for t in texts[at : at + TEXTS_AT_ONCE]]
            out += [self._text(w) for w in words] if self._prepared(words) else [self._long_text(w) for w in words]
        return out

    def _prepared(self, texts: list[list[str]]) -> bool:
        """Know all words of some texts at once; False if they are too many for the table."""
        needed = set(chain.from_iterable(texts))
        if len(needed) > CACHE_WORDS // 2:
            return False
        before = len(self.row)
        self._learn([w for w in needed if w not in self.row])
        if len(self.row) < before:  # the table was begun anew: what these texts share with the old one comes back
            self._learn([w for w in needed if w not in self.row])
        return True

    def _text(self, words: list[str]) -> tuple[np.ndarray, int] | None:
        if not words:
            return None
        return self.table[list(map(self.row.__getitem__, words))].sum(axis=0), sum(map(len, words)) + len(words)

    def _long_text(self, words: list[str]) -> tuple[np.ndarray, int] | None:
        """The same in parts, for texts of very many different words."""
        total, n = np.zeros(len(self.models.languages)), 0
        for at in range(0, len(words), CACHE_WORDS // 8):
            part = words[at : at + CACHE_WORDS // 8]
            self._prepared([part])
            scores, events = self._text(part)
            total, n = total + scores, n + events
        return (total, n) if n else None


def learn(docs: DataFrame, order: int = ORDER, part_cells: int = PART_CELLS) -> Models | None:
    """Models of all languages named in ``lang``, from all rows that have text and language and all of their events."""
    labelled = pick(docs, "text", "lang").filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    return models_of(save(count_events(labelled, order), "events"), order, part_cells)


def predict(docs: DataFrame, models: Models | None, *keep: str) -> DataFrame:
    """Language of each whole text, from the text alone.

    Returns ``doc_id``, the columns to keep, ``lang_pred, score, cross_entropy, n_events``. Null
    texts and texts without a letter, and all texts if nothing was learned, are ``und`` with score
    0 and null cross-entropy. Equal cross-entropies go to the first language by code point.
    ``score`` is the share of the language among all, with log probabilities divided by the root
    of the length.
    """
    kept = list(dict.fromkeys(["doc_id", *keep]))
    docs = pick(docs, *dict.fromkeys([*kept, "text"]))
    learned = models is not None
    mark = uuid.uuid4().hex
    names = ["lang_pred", "score", "cross_entropy", "n_events"]

    def make() -> Callable:
        scorer = worker_state(f"languages {mark}", lambda: Scorer(models)) if learned else None
        if scorer:
            scorer.models.renew(models)

        def row(found: tuple[np.ndarray, int] | None) -> tuple[str, float, float | None, int]:
            if found is None:
                return UNDETERMINED, 0.0, None, 0
            total, n = found
            entropy = -total / n
            best = int(np.argmin(entropy))
            share = np.exp((entropy[best] - entropy) * math.sqrt(n))
            return scorer.models.languages[best], float(1 / share.sum()), float(entropy[best]), n

        def step(columns: dict[str, list]) -> dict[str, list]:
            texts = columns["text"]
            rows = list(map(row, scorer.texts(texts) if scorer else [None] * len(texts)))
            return {k: columns[k] for k in kept} | {n: [r[i] for r in rows] for i, n in enumerate(names)}

        return step

    schema = StructType([*(docs.schema[k] for k in kept), *(StructField(n, t()) for n, t in zip(names, [StringType, DoubleType, DoubleType, LongType], strict=True))])
    return map_batches(docs, make, schema)


def with_rejection(predicted: DataFrame, labelled: Column, models: Models | None) -> DataFrame:
    """Adds ``rejected`` to predictions that carry ``lang``, calibrated on their labelled rows.

    Per language, the mean cross-entropy of the texts that have this label and prediction, and its
    spread per letter, give what a text of any length may reach: the way from the mean to the entropy
    of that language's own letters is the scale, whatever scripts other languages bring. ``und`` is always rejected; a
    language without such texts rejects nothing.
    """
    right = predicted.filter(labelled & (F.col("lang") == F.col("lang_pred")) & (F.col("n_events") > 0))
    sums = right.groupBy("lang_pred").agg(
        F.avg("cross_entropy").alias("mean"), F.avg("n_events").alias("n"),
        F.expr("avg(cross_entropy * n_events)").alias("en"), F.expr("avg(cross_entropy * cross_entropy * n_events)").alias("een"),
    )
    rejected = F.col("lang_pred") == UNDETERMINED
    for r in sums.collect():  # one row per language
        deviation = math.sqrt(max(0.0, r.een - 2 * r["mean"] * r.en + r["mean"] ** 2 * r.n))
        base = r["mean"] + MARGIN * max(0.0, models.of_letters[r.lang_pred] - r["mean"])
        limit = F.lit(base) + F.lit(STANDARD_ERRORS * deviation) / F.sqrt(F.greatest(F.col("n_events"), F.lit(1)))
        rejected = rejected | ((F.col("lang_pred") == r.lang_pred) & (F.col("cross_entropy") > limit))
    return predicted.withColumn("rejected", F.coalesce(rejected, F.lit(True)))


def identify(docs: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """Learn from the folds that are not held out and predict all rows.

    Returns ``doc_id, held_out, lang_pred, score, cross_entropy, n_events, rejected``, one row per
    input row. Null languages are not learned; an empty table gives an empty result.
    """
    docs = pick(docs, "doc_id", "text", "lang").withColumn("held_out", fold("doc_id", folds) == held)
    models = learn(docs.filter(~F.col("held_out")))
    predicted = save(predict(docs, models, "held_out", "lang"), "languages")
    return with_rejection(predicted, ~F.col("held_out"), models).drop("lang")


def recognised(docs: DataFrame) -> DataFrame:
    """The documents whose language is recognised; models come from all labelled rows of ``docs``."""
    docs = pick(docs, *DOCUMENT_COLUMNS)
    models = learn(docs)
    predicted = save(predict(docs, models, *DOCUMENT_COLUMNS), "languages")
    return with_rejection(predicted, F.lit(True), models).filter(~F.col("rejected")).select(*DOCUMENT_COLUMNS)
