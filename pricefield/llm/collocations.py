"""Phrase collocations per language, mined shard by shard and then counted exactly over all documents."""

from __future__ import annotations

from collections.abc import Iterator
from math import prod

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import settle, table

#: Parameters of the production query.
MAX_WORDS = 3
SUPPORT = 10
TOP = 2000
#: Shards of the corpus. A phrase reaches its share of the support in one of them; more shards lower that share.
SHARDS = 4
#: Words that a task counts before it hands its counts on.
WORDS = 500_000
#: Distinct words whose counts a task holds before it hands them on.
DISTINCT = 300_000
#: Bits of a filter of phrases worth counting; beyond its capacity more phrases are counted than needed.
FILTER_POWER = 26
#: All ends of pieces become points, which no word holds; blanks and tabs stand between words.
_PIECES = bytes.maketrans(b",;:!?\n\x0b\x0c\r", b"." * 9)
_MIX, _ADD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class Codes(dict):
    """Numbers for words in order of appearance; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


class Chunk:
    """Some texts as codes of their words, piece by piece, with the group of each place."""

    def __init__(self):
        self.vocabulary, self.parts, self.owners, self.size = Codes(), [], [], 0

    def add(self, text: bytes, group) -> None:
        tokens = text.lower().translate(_PIECES).replace(b".", b" . ").split()
        tokens.append(b".")
        self.parts.append(np.fromiter(map(self.vocabulary.__getitem__, tokens), np.int64, len(tokens)))
        self.owners.append(group)
        self.size += len(tokens)

    def close(self) -> Chunk:
        self.words = list(self.vocabulary)
        self.hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))
        self.groups = list(dict.fromkeys(self.owners))
        number = {g: i for i, g in enumerate(self.groups)}
        self.group = np.repeat([number[g] for g in self.owners], [len(p) for p in self.parts])
        self.codes, self.parts = np.concatenate(self.parts), []
        return self

    def whole(self, k: int) -> np.ndarray:
        """Whether k words of one piece start at a place (all places but the last k - 1)."""
        n = max(len(self.codes) - k + 1, 0)
        return np.logical_and.reduce([self.codes[i : i + n] != 0 for i in range(k)])

    def phrases(self, k: int) -> np.ndarray:
        """The 64-bit hash of the k words from each place on."""
        word, n = self.hashes[self.codes], max(len(self.codes) - k + 1, 0)
        out = np.full(n, k, np.uint64)
        for i in range(k):
            out = (out ^ word[i : i + n]) * _MIX
            out ^= out >> np.uint64(32)
        return out


def chunks(batches: Iterator[pa.RecordBatch], group: str) -> Iterator[Chunk]:
    """The texts of a task in chunks of about WORDS words: memory does not grow with the task."""
    chunk = Chunk()
    for batch in batches:
        for text, owner in zip(batch.column("text").cast(pa.binary()), batch.column(group).to_pylist()):
            chunk.add(text.as_py(), owner)
            if chunk.size >= WORDS:
                yield chunk.close()
                chunk = Chunk()
    if chunk.size:
        yield chunk.close()


def distinct(columns: list[np.ndarray], bounds: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of columns of numbers from 0 to below their bounds, and how often each occurs."""
    if prod(bounds) < 1 << 63:
        key = columns[0]
        for column, bound in zip(columns[1:], bounds[1:]):
            key = key * bound + column
        key, n = np.unique(key, return_counts=True)
        out = []
        for bound in bounds[:0:-1]:
            key, column = np.divmod(key, bound)
            out.append(column)
        return [key, *out[::-1]], n
    order = np.lexsort(columns)
    columns = [x[order] for x in columns]
    change = np.ones(len(order), bool)
    change[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in columns])
    first = np.flatnonzero(change)
    return [x[first] for x in columns], np.diff(np.append(first, len(order)))


def in_filter(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes >> np.uint64(64 - FILTER_POWER)
    return (bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0


def filter_of(hashes: DataFrame) -> np.ndarray:
    """A bit per `phrase` hash, in an array of fixed size whatever the number of phrases."""
    slot = F.shiftrightunsigned(F.col("phrase"), 64 - FILTER_POWER)
    words = hashes.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))
    out = np.zeros(1 << (FILTER_POWER - 6), np.int64)
    for batch in words.toArrow().to_batches():  # at most 2^(FILTER_POWER - 6) rows of two numbers
        out[batch.column("word").to_numpy()] = batch.column("bits").to_numpy()
    return out.view(np.uint8)


def mined(docs: DataFrame, k: int, parts: np.ndarray | None) -> DataFrame:
    """docs(text, shard): (shard, phrase, n), the counts of all k-word phrases of every shard, by their hashes.

    With `parts`, the filter of the promising phrases of k - 1 words, a phrase both of whose parts are not in it
    cannot reach the support and is not counted.
    """
    shared = docs.sparkSession.sparkContext.broadcast(parts)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "shard"):
            at = chunk.whole(k)
            if shared.value is not None and len(at):
                known = in_filter(shared.value, chunk.phrases(k - 1))
                at &= known[:-1] & known[1:]
            places = np.flatnonzero(at)
            phrase, group = chunk.phrases(k)[places].view(np.int64), chunk.group[places]
            order = np.argsort(group.astype(np.min_scalar_type(len(chunk.groups))), kind="stable")
            ends = np.searchsorted(group[order], np.arange(1, len(chunk.groups)))
            found, n = zip(*(np.unique(own, return_counts=True) for own in np.split(phrase[order], ends)))
            shard = np.repeat(np.array(chunk.groups, np.int64), [len(x) for x in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard), pa.array(np.concatenate(found)), pa.array(np.concatenate(n), pa.int64())], names=["shard", "phrase", "n"])

    rows = docs.select("text", "shard").mapInArrow(scan, "shard long, phrase long, n long")
    return rows.groupBy("shard", "phrase").agg(F.sum("n").alias("n"))


def promising(counts: DataFrame, local: DataFrame, support: int) -> DataFrame:
    """Of counts(shard, phrase, n) the phrases that are frequent in a shard and may reach `support` in a language.

    local(lang, shard, need): where a phrase is not frequent it stands at most need - 1 times. With these and its
    counts where it is frequent, a phrase that stays under the support cannot be a candidate.
    """
    rest = F.greatest(F.col("need") - 1, F.lit(0))
    local = local.withColumns({"rest": rest, "unseen": F.sum(rest).over(Window.partitionBy("lang"))})
    frequent = counts.join(local, "shard").where(F.col("n") >= F.col("need"))
    most = frequent.groupBy("lang", "phrase").agg((F.sum(F.col("n") - F.col("rest")) + F.max("unseen")).alias("most"))
    return most.where(F.col("most") >= support).select("phrase")


def counted(docs: DataFrame, wanted: dict[int, np.ndarray]) -> DataFrame:
    """docs(text, lang): (lang, k, phrase, n), the exact counts over all documents of all words (k = 1) and phrases.

    For each length in `wanted` the phrases of its filter are counted at every place where they stand.
    """
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def rows_of(langs: pa.Array, k: int, phrases: pa.Array, n) -> pa.RecordBatch:
        kinds = pa.array(np.full(len(langs), k, np.int32))
        return pa.RecordBatch.from_arrays([langs, kinds, phrases.cast(pa.string()), pa.array(n, pa.int64())], names=["lang", "k", "phrase", "n"])

    def words_of(words: dict[tuple[str, bytes], int]) -> pa.RecordBatch:
        return rows_of(pa.array([w[0] for w in words], pa.string()), 1, pa.array([w[1] for w in words], pa.binary()), list(words.values()))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[tuple[str, bytes], int] = {}
        for chunk in chunks(batches, "lang"):
            size = len(chunk.words)
            at = chunk.whole(1)
            (group, code), n = distinct([chunk.group[at], chunk.codes[at]], [len(chunk.groups), size])
            for g, c, count in zip(group.tolist(), code.tolist(), n.tolist()):
                word = chunk.groups[g], chunk.words[c]
                words[word] = words.get(word, 0) + count
            if len(words) >= DISTINCT:
                yield words_of(words)
                words.clear()
            langs, vocabulary = pa.array(chunk.groups, pa.string()), pa.array(chunk.words, pa.binary())
            for k, bits in shared.value.items():
                places = np.flatnonzero(chunk.whole(k) & in_filter(bits, chunk.phrases(k)))
                keys = [chunk.group[places], *[chunk.codes[places + i] for i in range(k)]]
                (group, *codes), n = distinct(keys, [len(chunk.groups), *[size] * k])
                texts = pc.binary_join_element_wise(*[vocabulary.take(pa.array(c)) for c in codes], pa.scalar(b" ", pa.binary()))
                yield rows_of(langs.take(pa.array(group)), k, texts, n)
        yield words_of(words)

    rows = docs.select("text", "lang").mapInArrow(scan, "lang string, k int, phrase string, n long")
    return rows.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))


def strength(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)) in whole numbers of up to 38 digits."""
    a, left, right = (c.cast("decimal(16,0)") for c in (a, left, right))
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (a * a), left * right).cast("long")


def part_of(phrase: Column, first: Column, length: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, length), " ")


def collocations(
    docs: DataFrame, max_words: int = MAX_WORDS, support: int = SUPPORT, top: int = TOP, shards: int = SHARDS,
) -> DataFrame:
    """docs(text, lang): the `top` strongest phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase is 2 to `max_words` words in a row of one piece (texts are cut at .,;:!? and line ends, A-Z in lower
    case); a = its occurrences, at least `support`; l and r are those of its two parts at its weakest cut, n all
    words of the language, score = floor(1000000 a a / (l r)). A phrase inside a longer candidate with at
    least half as many occurrences is left out.

    1. Documents are dealt into shards per language. A phrase that occurs `support` times among a language's n bytes
       of text reaches ceil(support * n_shard / n) in at least one shard. Each shard is mined completely at that lower
       support, by length: a phrase is only counted if both of its shorter parts passed.
    2. A phrase passes if it is frequent in a shard and its counts there, with the most that the other shards can
       hold unseen, reach `support`. These are counted over all documents, exactly and by their words.

    The first step goes by 64-bit hashes and filters of fixed size; both can only add candidates, which the
    second step counts and rejects. Null texts count as empty, a null language is `und`; repeated rows count each
    time. Long texts are one after another in a task's chunk of words. Ties have the smaller phrase in UTF-8 order first.
    A language without phrases, like an empty table, has no rows. Only text and lang are read, so no
    other column can clash.
    """
    text, lang = F.coalesce("text", F.lit("")), F.coalesce("lang", F.lit("und"))
    docs = docs.select(text.alias("text"), lang.alias("lang"))
    docs = docs.withColumn("shard", F.xxhash64("lang", F.pmod(F.xxhash64("text"), F.lit(shards))))

    sizes = docs.groupBy("lang", "shard").agg(F.sum(F.octet_length("text").cast("long")).alias("n"))
    sizes = settle(sizes, "shard-sizes")  # a row per language and shard
    whole = F.sum("n").over(Window.partitionBy("lang"))
    local = sizes.select("lang", "shard", F.ceil(F.col("n") * support / F.nullif(whole, F.lit(0))).alias("need"))

    wanted: dict[int, np.ndarray] = {}
    for k in range(2, max_words + 1):
        wanted[k] = filter_of(promising(mined(docs, k, wanted.get(k - 1)), local, support))
    counts = counted(docs, wanted).where((F.col("k") == 1) | (F.col("n") >= support))
    counts = settle(counts, "phrase-counts")

    phrases = counts.where("k > 1").select("lang", "k", "phrase", F.col("n").alias("a"))
    lengths = F.sequence(F.lit(2), F.col("k") - 1)
    inner = phrases.where("k > 2").select("lang", "phrase", "k", "a", F.explode(lengths).alias("length"))
    inner = inner.select("lang", "phrase", "a", "length", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("length") + 1)).alias("first"))
    inner = inner.groupBy("lang", part_of(F.col("phrase"), F.col("first"), F.col("length")).alias("phrase")).agg(F.max("a").alias("longer"))
    kept = phrases.join(inner, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < 50 * F.col("a"), F.lit(True)))

    cuts = kept.select("lang", "phrase", "k", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.withColumns({
        "left": part_of(F.col("phrase"), F.lit(1), F.col("cut")),
        "right": part_of(F.col("phrase"), F.col("cut") + 1, F.col("k") - F.col("cut")),
    })
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side])
    cuts = cuts.withColumn("score", strength(F.col("a"), F.col("l"), F.col("r")))
    weakest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("w"))
    weakest = weakest.select("lang", "phrase", "a", "w.l", "w.r", "w.score")

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = weakest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    total = counts.where("k = 1").groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents
), w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM w CROSS JOIN (VALUES (1), (2), (3)) t(k) WHERE len(w) >= k
), f AS MATERIALIZED (SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY ALL),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
inner_ AS (
  SELECT lang, phrase, max(a) AS longer
  FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM c WHERE k = 3) GROUP BY ALL
), cuts AS (
  SELECT c.lang, c.phrase, a, cut, x.f AS l, y.f AS r, 1000000 * a * a // (x.f * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1:c.k], ' ')
), weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), total AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang)
SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank, w.phrase,
  CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM weakest w JOIN total USING (lang) LEFT JOIN inner_ i ON i.lang = w.lang AND i.phrase = w.phrase
WHERE i.longer IS NULL OR 100 * i.longer < 50 * a
QUALIFY rank <= 2000
"""
