"""Near-duplicate detection with min-max hashing: signatures of minima and maxima, banded, candidates verified."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle, table
from .components import components
from .jaccard import document_key, shingles, token_sets, verified_links

#: Permutations; each gives two values of the signature, its minimum and its maximum.
PERMUTATIONS = 240
#: Values of a band and bands. 40 bands miss a pair at a similarity of 0.8 with a chance of 1.2e-7; all values estimate.
BAND, BANDS = 5, 40
#: Standard errors that an estimate may lie below the wanted similarity before a candidate is left out.
SLACK = 4.5
#: Signatures of a bucket that are compared as one block, and tokens hashed at once.
BLOCK = 64
TOKENS = 1 << 13
#: Rounds, at most, in which every class is compared with one hub before whole buckets are. A round that links less
#: than this share of its pairs is the last: the groups are joined, and whole buckets are compared for the rest.
ROUNDS, WORTH = 3, 0.02


def permutation_constants(permutations: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets: x -> a x + b is a permutation of the 64-bit numbers."""
    names = [xxhash.xxh64_intdigest(str(i).encode(), seed=13) for i in range(2 * permutations)]
    return np.array(names[:permutations], np.uint64) | np.uint64(1), np.array(names[permutations:], np.uint64)


def signature(tokens: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The minimum and the maximum of the token set under each permutation, one behind the other."""
    x = tokens.view(np.uint64)
    low, high = np.full(len(factors), ~np.uint64(0)), np.zeros(len(factors), np.uint64)
    for i in range(0, len(x), TOKENS):
        hashed = factors[:, None] * x[None, i : i + TOKENS] + offsets[:, None]
        low, high = np.minimum(low, hashed.min(1)), np.maximum(high, hashed.max(1))
    return np.stack([low, high], 1).ravel()


def band_keys(values: np.ndarray, band: int) -> np.ndarray:
    """One 64-bit key per band of the signature; the place of a band is part of its key."""
    rows = values.reshape(-1, band)
    keys = np.arange(1, len(rows) + 1, dtype=np.uint64)
    for j in range(band):
        keys = (keys ^ rows[:, j]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def signed_classes(docs: DataFrame, k: int, permutations: int, band: int) -> DataFrame:
    """Per document doc_id, mark, n, the 128-bit name (ca, cb) of its token set, band keys and a byte per signature value."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, offsets = permutation_constants(permutations)
        for batch in batches:
            sizes, names, bands, codes = [], [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                tokens = shingles(text, k)
                sizes.append(len(tokens))
                names.append(np.frombuffer(xxhash.xxh3_128_digest(tokens.tobytes()), np.int64))
                values = signature(tokens, factors, offsets)
                bands.append(band_keys(values[: BANDS * band], band) if len(tokens) else np.empty(0, np.int64))
                codes.append(((values * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(56)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("mark"), pa.array(sizes, pa.int32()),
                pa.array([c[0] for c in names], pa.int64()), pa.array([c[1] for c in names], pa.int64()),
                pa.array(bands, pa.list_(pa.int64())), pa.array(codes, pa.binary()),
            ], names=["doc_id", "mark", "n", "ca", "cb", "bands", "codes"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    return rows.mapInArrow(scan, "doc_id long, mark long, n int, ca long, cb long, bands array<long>, codes binary")


def of_several(rows: DataFrame) -> DataFrame:
    """The rows (key, band, ca, n, comp) of buckets that hold more than one component."""
    mixed = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    return rows.join(mixed.select("key"), "key")


def hub_pairs(rows: DataFrame, used: DataFrame, percent: int) -> DataFrame:
    """(a, b): each class with the hub that most of its buckets name.

    The hub of a bucket is its class that meets most others over all its buckets: the original in a group of copies,
    which are nearer to it than to each other. Hubs of earlier rounds, used(ca), are left out.
    """
    sizes = rows.groupBy("key").agg(F.count("*").alias("size"))
    central = rows.join(sizes, "key").groupBy("ca").agg(F.sum("size").alias("meets")).join(used, "ca", "left_anti")
    hubs = rows.join(central, "ca").groupBy("key").agg(F.max(F.struct("meets", "ca", "n", "comp")).alias("hub"))
    votes = rows.join(hubs, "key").where(
        (F.col("comp") != F.col("hub.comp")) & (100 * F.col("n") >= percent * F.col("hub.n")) & (100 * F.col("hub.n") >= percent * F.col("n"))
    ).groupBy("ca", F.col("hub.ca").alias("hub")).agg(F.count("*").alias("count"), F.max("hub.meets").alias("meets"))
    most = votes.groupBy("ca").agg(F.max_by("hub", F.struct("count", "meets", "hub")).alias("hub"))
    return most.select(F.col("ca").alias("a"), F.col("hub").alias("b"))


def joined(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """rows(key, band, ca, n, ...) with the component `comp` of their class, from roots(a, b): class and root."""
    found = roots.select(F.col("a").alias("ca"), F.col("b").alias("root"))
    return rows.drop("comp").join(found, "ca", "left").select("key", "band", "ca", "n", F.coalesce("root", "ca").alias("comp"))


def block_pairs(rows: DataFrame, codes: DataFrame, percent: int, band: int) -> DataFrame:
    """(a, b): the pairs of classes of different components in one bucket whose signatures agree enough.

    A bucket is cut into blocks of about BLOCK classes. Two blocks meet as one row and their signatures are
    compared there, so a pair of classes is a row only if it is a likely one, and only from the first bucket it
    shares. Blocks are formed by component, so two blocks that lie wholly in the same component never meet.
    """
    sizes = rows.groupBy("key", "comp").agg(F.count("*").alias("m"))
    large = sizes.where(F.col("m") > BLOCK)
    rest = sizes.where(F.col("m") <= BLOCK).groupBy("key").agg(F.ceil(F.sum("m") / BLOCK).alias("rest"))
    dealt = rows.join(large, ["key", "comp"], "left").join(rest, "key", "left")
    own = F.col("m").isNotNull()
    part = F.when(own, F.xxhash64("comp", F.pmod(F.xxhash64("ca"), F.ceil(F.col("m") / BLOCK)))).otherwise(
        F.pmod(F.xxhash64("comp"), F.col("rest")))
    dealt = dealt.select("key", "band", part.alias("block"), F.when(own, F.col("comp")).alias("only"), "ca", "n", "comp")
    held = dealt.join(codes, "ca").groupBy("key", "band", "block", "only").agg(
        F.collect_list(F.struct("ca", "n", "comp", "codes")).alias("held"))
    held = settle(held, "bucket-blocks")
    other = held.select("key", "band", F.col("block").alias("to"), F.col("only").alias("sole"), F.col("held").alias("others"))
    meet = held.join(other, ["key", "band"]).where(
        (F.col("block") < F.col("to")) & ~F.coalesce(F.col("only") == F.col("sole"), F.lit(False))
        | (F.col("block") == F.col("to")) & F.col("only").isNull() & F.col("sole").isNull())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share = percent / 100

        def parts(cells: list[dict]) -> tuple[np.ndarray, ...]:
            kinds = [np.array([c[x] for c in cells], np.int64) for x in ("ca", "n", "comp")]
            return *kinds, np.frombuffer(b"".join(c["codes"] for c in cells), np.uint8).reshape(len(cells), -1)

        for batch in batches:
            found = []
            for place, left, right in zip(*(batch.column(c) for c in ("band", "held", "others"))):
                (a, n, x, s), (b, m, y, t) = parts(left.as_py()), parts(right.as_py())
                least = (share - SLACK * np.sqrt(share * (1 - share) / s.shape[1])) * s.shape[1]
                for i in range(len(a)):
                    near = (y != x[i]) & (100 * m >= percent * n[i]) & (100 * n[i] >= percent * m)
                    same = t[near] == s[i]
                    first = same[:, : BANDS * band].reshape(len(same), BANDS, band).all(2).argmax(1) == place.as_py()
                    near[near] = first & (np.count_nonzero(same, axis=1) >= least)
                    found += [(a[i], c) if a[i] < c else (c, a[i]) for c in b[near]]
            one, two = zip(*set(found)) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64())], names=["a", "b"])

    return meet.select("band", "held", "others").mapInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, permutations: int = PERMUTATIONS, band: int = BAND) -> DataFrame:
    """docs(doc_id, text): per row doc_id, mark (hash of the text), n_shingles and component_id.

    Two documents link when the overlap of their sets of k-word shingles, confirmed on the full sets, is at
    least `percent` % of their union; component_id is the smallest doc_id reachable by links, the own one included.

    1. Every permutation of the shingle hashes gives two signature values, the smallest and the largest
       hash of the set, at half the hashing of plain minima. `band` values in a row are one bucket key.
    2. Equal sets form one class. Each class is verified against the hub most of its buckets name, up to ROUNDS
       times with new hubs, so a large group of copies costs a comparison per class and is one component afterwards.
    3. In buckets that still hold several components all signatures of different components are compared,
       block by block, and pairs that are likely enough are verified. No bucket is capped.

    Null and empty texts have no shingles and link with nothing; a text of fewer than k words is one shingle. Long
    texts are hashed in pieces. Rows with a null id link like others, and a component of null ids only has a null
    component_id. Repeated rows give repeated results. Shingles are 64-bit hashes, and a class goes by
    64 bits of its set while it is compared. Only doc_id and text are read, so no other column can clash.
    """
    docs = docs.select("doc_id", "text")
    rows = settle(signed_classes(docs, k, permutations, band), "minmax-signatures")
    classes = rows.where("n > 0").groupBy("ca", "cb").agg(
        F.min("doc_id").alias("first"), F.min(document_key(F.col("doc_id"), F.col("mark"))).alias("key"))
    classes = settle(classes, "minmax-classes")

    def sets_of(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.col("a").alias("ca")).union(pairs.select("b")).distinct()
        return settle(token_sets(docs, classes.join(wanted, "ca").select("key", "ca"), k), "minmax-sets")

    def confirmed(pairs: DataFrame, label: str) -> DataFrame:
        return settle(verified_links(pairs, sets_of(pairs), percent), f"{label}-links")

    signed = rows.where("n > 0").select("ca", "n", "bands", "codes").dropDuplicates(["ca"])
    buckets = signed.select(F.posexplode("bands").alias("band", "key"), "ca", "n", F.col("ca").alias("comp"))
    buckets = settle(of_several(buckets), "shared-buckets")
    # Components so far as links (class, root): they stand for all links found, so each round starts from them.
    roots, used = None, buckets.select("ca").limit(0)

    def grown(found: DataFrame) -> DataFrame:
        return components(found if roots is None else roots.union(found)).select(F.col("node").alias("a"), F.col("root").alias("b"))

    for _ in range(ROUNDS):
        pairs = settle(hub_pairs(buckets, used, percent), "hub-pairs")
        found = confirmed(pairs, "hub")
        used = used.union(pairs.select("b")).distinct()
        roots = grown(found)
        buckets = settle(of_several(joined(buckets, roots)), "shared-buckets")
        if found.count() < WORTH * pairs.count():
            break
    codes = signed.join(buckets.select("ca").distinct(), "ca", "left_semi").select("ca", "codes")
    roots = grown(confirmed(settle(block_pairs(buckets, codes, percent, band), "block-pairs"), "block"))

    linked = classes.join(roots.select(F.col("a").alias("ca"), F.col("b").alias("root")), "ca").select("ca", "cb", "first", "root")
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    linked = linked.join(least, "root").select("ca", "cb", "root", "least")
    named = classes.join(linked, ["ca", "cb"], "left").select(
        "ca", "cb", F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("least")).alias("component_id"))
    full = rows.where("n > 0").join(named, ["ca", "cb"]).select("doc_id", "mark", F.col("n").alias("n_shingles"), "component_id")
    empty = rows.where("n = 0").select("doc_id", "mark", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)


def op13_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)
    return found.select(
        "doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


OP13_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)
), reach AS (
  SELECT doc_id, doc_id AS r FROM w UNION SELECT doc_id, b FROM reach JOIN links ON r = a
), least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN least ON least.doc_id = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id
"""
