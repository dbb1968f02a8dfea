"""Similarity join of documents on word shingles with a token-group matrix."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import join_key, settle, table
from .components import components

#: Slots of the token histogram; tokens are ordered by the count of their slot.
SLOTS = 1 << 18
#: Members of a group whose tokens are united, and queries that one copy of a group answers.
GROUP = 32
QUERIES = 4096
#: Bits of the filter that keeps unwanted texts out of a shuffle.
FILTER_BITS = 1 << 23
_MIX, _ADD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def shingles(text: bytes | None, k: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's k-word shingles, A-Z in lower case."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.int64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = max(len(words) - k + 1, 1)
    out = np.full(n, min(len(words), k), np.uint64)
    for i in range(min(len(words), k)):
        out = (out ^ hashes[i : i + n]) * _MIX
        out ^= out >> np.uint64(29)
        out = out * _ADD
        out ^= out >> np.uint64(32)
    return np.unique(out.view(np.int64))


def overlap_needed(n: int, percent: int) -> int:
    """The least overlap that a set of n tokens has with any set similar to it."""
    return -(-percent * n // 100)


def least_shared(n: Column, percent: int) -> Column:
    """Prefix tokens that a set of n tokens shares with any set similar to it; see `prefix_length`."""
    return F.least(F.greatest(F.floor(n / 16), F.lit(4)), F.ceil(n * percent / 100))


def surely_shared(n: Column, percent: int) -> Column:
    """Prefix tokens shared by a set of n tokens and any set similar to it, the smallest such set included."""
    smallest = F.greatest(F.floor(n * percent / 100), F.lit(1))
    return F.least(least_shared(n, percent), least_shared(smallest, percent))


def prefix_length(n: int, percent: int) -> int:
    """Of the common tokens of two similar sets all but the first s may stand behind the first n - needed + s tokens.

    So both prefixes hold s common tokens. A larger s costs longer prefixes and keeps accidental pairs out.
    """
    return min(n, n - overlap_needed(n, percent) + max(n // 16, 4))


def _rows(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        yield batch, [shingles(t, k) for t in texts.to_pylist()]


def document_classes(docs: DataFrame, k: int) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, mark, n, ca, cb) per document, and the histogram of all documents' tokens.

    ca and cb are 128 bits over the token set, equal for equal sets. The histogram has SLOTS counts whatever
    the corpus; each task adds one row of counts to the table.
    """
    def scan(batches):
        counts = np.zeros(SLOTS, np.int64)
        kinds = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("n", pa.int32()), ("ca", pa.int64()),
                           ("cb", pa.int64()), ("counts", pa.list_(pa.int64()))])
        for batch, sets in _rows(batches, k):
            names = [np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64) for s in sets]
            if sets:
                counts += np.bincount(np.concatenate(sets) & (SLOTS - 1), minlength=SLOTS)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("mark"), pa.array([len(s) for s in sets], pa.int32()),
                pa.array([c[0] for c in names], pa.int64()), pa.array([c[1] for c in names], pa.int64()),
                pa.nulls(len(sets), pa.list_(pa.int64())),
            ], schema=kinds)
        one = [pa.nulls(1, f.type) for f in kinds][:5] + [pa.array([counts], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(one, schema=kinds)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    both = rows.mapInArrow(scan, "doc_id long, mark long, n int, ca long, cb long, counts array<long>")
    both = settle(both, "token-classes")
    slots = both.where("counts IS NOT NULL").select(F.posexplode("counts").alias("slot", "n")).where("n > 0")
    counts = np.zeros(SLOTS, np.int64)
    for row in slots.groupBy("slot").agg(F.sum("n").alias("n")).collect():  # at most SLOTS rows
        counts[row.slot] = row.n
    return both.where("counts IS NULL").drop("counts"), counts


def prefix_tokens(docs: DataFrame, counts: np.ndarray, k: int, percent: int) -> DataFrame:
    """(token, ca, n): of each set the `prefix_length` rarest tokens, ordered by their slot's count, then by value."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def scan(batches):
        seen: set[int] = set()  # equal sets of a task are written once
        for _, sets in _rows(batches, k):
            tokens, owners, sizes = [], [], []
            for s in sets:
                if not len(s):
                    continue
                name = int(np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)[0])
                if name in seen:
                    continue
                if len(seen) < 100_000:
                    seen.add(name)
                first = prefix_length(len(s), percent)
                part = s[np.lexsort((s, shared.value[s & (SLOTS - 1)]))[:first]]
                tokens.append(part)
                owners.append(np.full(first, name, np.int64))
                sizes.append(np.full(first, len(s), np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (tokens, owners, sizes)], names=["token", "ca", "n"]
                )

    return docs.select("text").mapInArrow(scan, "token long, ca long, n int")


def token_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(ca, tokens) of the classes in wanted(key, ca), read from the texts of one document of each.

    A bit per hashed key, in an array of fixed length, keeps most other texts out of the shuffle.
    """
    def scan(batches):
        for batch, sets in _rows(batches, k):
            yield pa.RecordBatch.from_arrays([batch.column("ca"), pa.array(sets, pa.list_(pa.int64()))], names=["ca", "tokens"])

    slot = F.pmod(F.xxhash64("key"), F.lit(FILTER_BITS))
    bits = wanted.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))
    every = docs.sparkSession.range(FILTER_BITS // 64).withColumnRenamed("id", "word").join(bits, "word", "left")
    every = every.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))),
                                  lambda x: x["bits"]).alias("bits"))
    every = settle(every, "wanted-texts")
    keyed = docs.select(document_key(F.col("doc_id"), F.xxhash64("text")).alias("key"), "text")
    here = F.getbit(F.get(every.scalar(), F.shiftright(slot, 6).cast("int")), slot.bitwiseAND(F.lit(63)).cast("int"))
    texts = keyed.where(here == 1).join(wanted, "key").select("ca", "text")
    return texts.mapInArrow(scan, "ca long, tokens array<long>").dropDuplicates(["ca"])


def document_key(doc_id: Column, mark: Column) -> Column:
    return F.concat_ws(":", join_key(doc_id), mark.cast("string"))


def similar(a: Column, b: Column, percent: int) -> Column:
    both = F.size(F.array_intersect(a, b))
    return 100 * both >= percent * (F.size(a) + F.size(b) - both)


def verified_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """pairs(a, b) of classes whose token sets are similar."""
    left, right = sets.select(F.col("ca").alias("a"), F.col("tokens").alias("x")), sets.select(F.col("ca").alias("b"), F.col("tokens").alias("y"))
    return pairs.join(left, "a").join(right, "b").where(similar(F.col("x"), F.col("y"), percent)).select("a", "b")


def fitting(n: Column, other: Column, percent: int) -> Column:
    return (n * 100 >= other * percent) & (other * 100 >= n * percent)


def enough(shared: Column, n: Column, other: Column, percent: int) -> Column:
    """Whether two sets of these sizes share so many prefix tokens that they may be similar."""
    return shared >= F.least(least_shared(n, percent), least_shared(other, percent))


def promising(rows: DataFrame, percent: int) -> DataFrame:
    """The rows (token, ca, n) of tokens that several classes hold, without classes that hold too few of them."""
    several = rows.groupBy("token").agg(F.min("ca").alias("lo"), F.max("ca").alias("hi")).where("lo <> hi")
    rows = settle(rows.join(several.select("token"), "token").distinct(), "shared-tokens")
    few = rows.groupBy("ca", "n").count().where(F.col("count") < surely_shared(F.col("n"), percent))
    return rows.join(few.select("ca"), "ca", "left_anti").select("token", "ca", "n")


def group_links(asked: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) found by asking groups: asked(ca, g) and members(ca, c, g) with the token sets of all.

    The token-group matrix row of a group is the union of its members' tokens. It bounds the overlap of the
    asking set with every member; only a group that reaches the needed overlap is opened, and then one look-up
    of the set counts the overlap with each member. Members come first in a task and are at most about GROUP;
    the queries stream by. A group asked by many is copied, so that no task answers more than about QUERIES.
    Of the links found in a group only those are returned that join parts not yet joined.
    """
    copies = asked.groupBy("g").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("copies"))
    every = members.join(copies, "g").select("ca", "c", "g", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    every = every.join(sets, "ca").select("g", "copy", F.lit(0).alias("asks"), "ca", "c", "tokens")
    asks = asked.join(copies, "g").join(sets, "ca")
    asks = asks.select("g", F.pmod(F.xxhash64("ca"), F.col("copies")).cast("int").alias("copy"), F.lit(1).alias("asks"), "ca",
                       F.col("ca").alias("c"), "tokens")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group, top, matrix = None, [], {}, None

        def root(x: int) -> int:
            while top.setdefault(x, x) != x:
                top[x] = x = top[top[x]]
            return x

        for batch in batches:
            out = []
            tokens = batch.column("tokens")
            flat, ends = tokens.values.to_numpy(), tokens.offsets.to_numpy()
            names = zip(*(batch.column(c).to_numpy() for c in ("g", "copy", "asks", "ca", "c")))
            for i, (g, copy, asking, ca, c) in enumerate(names):
                mine = flat[ends[i] : ends[i + 1]]
                if (g, copy) != key:
                    key, group, top, matrix = (g, copy), [], {}, None
                if not asking:
                    group.append((ca, mine))
                    top[root(ca)] = root(c)
                    continue
                if matrix is None:
                    matrix = (np.concatenate([t for _, t in group]), np.repeat(np.arange(len(group)), [len(t) for _, t in group]))
                    order = np.argsort(matrix[0], kind="stable")
                    matrix = (matrix[0][order], matrix[1][order], np.array([len(t) for _, t in group]))
                held, owner, sizes = matrix
                first, last = np.searchsorted(held, mine, "left"), np.searchsorted(held, mine, "right")
                reach = np.count_nonzero(last > first)
                if reach * (100 + percent) < (len(mine) + sizes.min()) * percent:
                    continue
                spans = last - first
                at = np.repeat(first - np.concatenate(([0], np.cumsum(spans)[:-1])), spans) + np.arange(spans.sum())
                both = np.bincount(owner[at], minlength=len(group))
                for j in np.flatnonzero(100 * both >= percent * (len(mine) + sizes - both)):
                    other = group[j][0]
                    if root(other) != root(ca):
                        top[root(other)] = root(ca)
                        out.append((ca, other))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["a", "b"])

    dealt = every.union(asks).repartition("g", "copy").sortWithinPartitions("g", "copy", "asks")
    return dealt.mapInArrow(answer, "a long, b long")


def far_groups(kept: DataFrame, percent: int) -> DataFrame:
    """(ca, g): the groups of other clusters that a class must ask, from the prefix tokens kept(token, ca, n, h, g).

    Two similar sets share at least s prefix tokens. The rarest of these is not among the s - 1 tokens that most
    classes hold, in either set, so those need no look-up: passages that many unlike documents quote pair none of
    them. A group found so must then hold, in the union of its members' prefix tokens, s tokens of the class.
    """
    mixed = kept.groupBy("token").agg(F.min("h").alias("lo"), F.max("h").alias("hi"), F.count("*").alias("held"))
    shown = settle(kept.join(mixed.where("lo <> hi").select("token", "held"), "token"), "mixed-tokens")
    common_first = Window.partitionBy("ca").orderBy(F.desc("held"), "token")
    rare = shown.withColumn("rank", F.row_number().over(common_first)).where(F.col("rank") >= surely_shared(F.col("n"), percent))
    rare = settle(rare.select("token", "ca", "n", "h", "g"), "rare-tokens")
    heads = rare.groupBy("token", F.col("h").alias("g_h"), F.col("g").alias("g_g")).agg(
        F.min("n").alias("g_least"), F.max("n").alias("g_most"))
    fits = (F.col("n") * 100 >= F.col("g_least") * percent) & (F.col("g_most") * 100 >= F.col("n") * percent)
    found = rare.withColumnRenamed("token", "own").join(
        heads, (F.col("own") == F.col("token")) & (F.col("h") != F.col("g_h")) & (F.col("g") > F.col("g_g")) & fits)
    found = found.select("ca", F.col("g_g").alias("g")).distinct()
    asking = shown.groupBy("ca", "n").agg(F.collect_set("token").alias("own"))
    unions = shown.groupBy("g").agg(F.collect_set("token").alias("held"), F.min("n").alias("least"))  # about GROUP prefixes
    found = found.join(asking, "ca").join(unions, "g")
    both = F.size(F.array_intersect("held", "own"))
    return found.where(enough(both, F.col("n"), F.col("least"), percent)).select("ca", "g")


def class_links(rows: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """Links (a, b) that connect all similar classes, from the prefix tokens rows(token, ca, n).

    1. Each class votes for the smallest owner of its tokens; the class most voted for is its hub. Sets are
       compared with their hub's: one comparison per class, however large a group of copies is.
    2. Components of these links and the classes that voted for them form clusters; clusters are cut into groups
       of about GROUP similar classes. A class asks the groups of its cluster, and by shared prefix tokens the
       groups of other clusters; of two groups only the later one asks. A group that is wholly in the asking
       class's component needs no look: no link between components is missed.
    """
    shared = settle(promising(promising(rows, percent), percent), "promising-tokens")
    owner = shared.groupBy("token").agg(F.min_by(F.struct("ca", "n"), "ca").alias("hub"))
    votes = shared.join(owner, "token").select("ca", "n", F.col("hub.ca").alias("hub"), F.col("hub.n").alias("other"))
    votes = votes.where((F.col("ca") != F.col("hub")) & fitting(F.col("n"), F.col("other"), percent))
    votes = votes.groupBy("ca", "n", "hub", "other").count().where(enough(F.col("count"), F.col("n"), F.col("other"), percent))
    hubs = votes.groupBy("ca").agg(F.max_by("hub", F.struct("count", "hub")).alias("hub"))
    hubs = settle(hubs.select(F.col("ca").alias("a"), F.col("hub").alias("b")), "star-pairs")
    stars = verified_links(hubs, sets_of(hubs.select(F.col("a").alias("ca")).union(hubs.select("b"))), percent)
    stars = settle(stars, "star-links")
    roots = components(stars).select(F.col("node").alias("ca"), "root")

    cluster = hubs.join(roots.select(F.col("ca").alias("b"), "root"), "b", "left").select(F.col("a").alias("ca"), F.coalesce("root", "b").alias("hub"))
    members = shared.select("ca", "n").distinct().join(roots, "ca", "left").join(cluster, "ca", "left")
    linked = F.col("root").isNotNull()
    members = members.select("ca", "n", F.coalesce("root", "ca").alias("c"), linked.alias("linked"),
                             F.coalesce("root", "hub", "ca").alias("h"))
    share = members.groupBy("h", "linked").agg(F.ceil(F.count("*") / GROUP).alias("parts"))
    part = F.pmod(F.xxhash64("ca"), F.col("parts"))
    members = members.join(share, ["h", "linked"]).withColumn("g", F.xxhash64("h", "linked", part)).drop("parts")
    members = settle(members, "group-members")
    groups = members.groupBy("g", "h").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.count("*").alias("size"),
        F.when(F.min("c") == F.max("c"), F.min("c")).alias("only"),
    )
    groups = groups.select(*[F.col(x).alias(f"g_{x}") for x in ("g", "h", "least", "most", "size", "only")])
    fits = (F.col("n") * 100 >= F.col("g_least") * percent) & (F.col("g_most") * 100 >= F.col("n") * percent)
    other = ~F.col("c").eqNullSafe(F.col("g_only")) & ((F.col("g") > F.col("g_g")) | ((F.col("g") == F.col("g_g")) & (F.col("g_size") > 1)))
    near = members.join(groups, (F.col("h") == F.col("g_h")) & fits & other).select("ca", F.col("g_g").alias("g"))

    kept = shared.join(members.select("ca", "h", "g"), "ca")
    asked = settle(near.union(far_groups(kept, percent)), "asked-groups")

    members = settle(members.join(asked.select("g").distinct(), "g").select("ca", "c", "g"), "asked-members")
    sets = sets_of(members.select("ca").union(asked.select("ca")))
    return stars.union(group_links(asked, members, sets, percent))


def link_documents(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """docs(doc_id, text): per row doc_id, mark (hash of the text), n_shingles, component_id and group.

    Two documents link when the overlap of their sets of k-word shingles is at least `percent` % of their
    union; component_id is the smallest doc_id reachable by links, the own one included. A text of fewer
    words is one shingle. Null and empty texts have no shingles and link with nothing. Equal sets form one
    class and are compared once; rows with a null id link like others, and a component of null ids only
    has a null component_id. Tokens are 64-bit hashes, and a class goes by 64 bits of its set while it is
    compared. `group` is null without shingles, else the same for a component's rows. Repeated rows give repeated results.
    """
    rows, counts = document_classes(docs, k)
    prefixes = settle(prefix_tokens(docs, counts, k, percent), "prefix-tokens")
    classes = rows.where("n > 0").groupBy("ca", "cb").agg(
        F.min("doc_id").alias("first"), F.min(document_key(F.col("doc_id"), F.col("mark"))).alias("key")
    )
    classes = settle(classes, "classes")

    def sets_of(wanted: DataFrame) -> DataFrame:
        keys = classes.join(wanted.select("ca").distinct(), "ca").select("key", "ca")
        return settle(token_sets(docs, keys, k), "token-sets")

    found = components(class_links(prefixes, sets_of, percent)).select(F.col("node").alias("ca"), "root")
    linked = classes.join(found, "ca").select("ca", "cb", "first", "root")
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    linked = linked.join(least, "root").select("ca", "cb", "least", "root")
    own = F.concat_ws(":", "ca", "cb")
    named = classes.join(linked, ["ca", "cb"], "left").select(
        "ca", "cb", F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("least")).alias("component_id"),
        F.coalesce(F.col("root").cast("string"), own).alias("group"),
    )
    shown = ["doc_id", "mark", F.col("n").alias("n_shingles"), "component_id", "group"]
    full = rows.where("n > 0").join(named, ["ca", "cb"]).select(*shown)
    empty = rows.where("n = 0").withColumns({"component_id": F.col("doc_id"), "group": F.lit(None).cast("string")}).select(*shown)
    return full.unionByName(empty)


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The row of docs with the smallest (doc_id, mark) of each group of `found`, and all rows without shingles."""
    rows = found.where("n_shingles > 0").groupBy("group", "doc_id", "mark").count()
    first = rows.groupBy("group").agg(F.min(F.struct("doc_id", "mark", "count")).alias("f"))
    kept = first.select(document_key(F.col("f.doc_id"), F.col("f.mark")).alias("__key"), F.col("f.count").alias("__rows"))
    empty = found.where("n_shingles = 0").select(document_key(F.col("doc_id"), F.col("mark")).alias("__key"), F.lit(1).alias("__rows"))
    kept = settle(kept.unionByName(empty.distinct()), "kept-documents")
    keyed = docs.withColumn("__key", document_key(F.col("doc_id").cast("long"), F.xxhash64("text")))
    out = keyed.join(kept.where("__rows = 1"), "__key")
    if kept.where("__rows > 1").head(1):  # rows that repeat as a whole
        out = out.union(keyed.join(kept.where("__rows > 1"), "__key").dropDuplicates(["__key"]))
    return out.drop("__key", "__rows")


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = link_documents(docs, k=3, percent=90)
    return found.select("doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), "component_id")


OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 90 * (x.n + y.n - k)
), reach AS (
  SELECT doc_id, doc_id AS r FROM w UNION SELECT doc_id, b FROM reach JOIN links ON r = a
)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, (SELECT min(r) FROM reach WHERE reach.doc_id = w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id
"""
