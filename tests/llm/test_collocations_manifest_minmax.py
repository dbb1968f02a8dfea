"""Phrases, manifests and min-max near duplicates against plain Python on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

from corpus_tables import DOCS, odd_documents

import numpy as np

from pricefield.llm import collocations as collocations_module
from pricefield.llm.catalog import QUERIES
from pricefield.llm.collocations import collocations, strength
from pricefield.llm.manifest import leaf_digest, manifest
from pricefield.llm.minmax import near_duplicates, permutation_constants, signature
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_collocations(rows, max_words, support, top):
    counts, out = defaultdict(Counter), []
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, max_words + 1):
                counts["und" if lang is None else lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        longest = Counter()
        for p, a in cands.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longest[p[i : i + k]] = max(longest[p[i : i + k]], a)
        found = []
        for p, a in cands.items():
            if 100 * longest[p] >= 50 * a:
                continue
            score, cut = min((1000000 * a * a // (f[p[:c]] * f[p[c:]]), c) for c in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])]
    return sorted(out)


def test_collocations_on_odd_rows(spark, odd):
    rows = [(r[1], r[2]) for r in odd_documents()]
    got = [tuple(r) for r in QUERIES["op11_collocations"](spark, odd).collect()]
    assert sorted(got) == plain_collocations(rows, 3, 10, 2000) and got


def test_collocations_of_longer_phrases_and_several_shards(spark):
    random.seed(5)
    words = ["The", "old", "mill", "river", "stone", "é", "x\x1cy", "KK"]
    rows = [(" ".join(random.choices(words, [9, 5, 3, 2, 2, 1, 1, 1], k=random.randint(0, 60))) + random.choice([". ", "\n", "\t", ";a"]) * 2
             + "the old mill", random.choice(["en", None, "und", "fr"])) for _ in range(300)]
    docs = spark.createDataFrame(rows, "text string, lang string").withColumn("n", F.lit("clash"))
    for max_words, support, top, shards in ((4, 6, 50, 4), (2, 25, 2000, 1), (3, 7, 2000, 9)):
        got = sorted(tuple(r) for r in collocations(docs, max_words, support, top, shards).collect())
        assert got == plain_collocations(rows, max_words, support, top)


def test_phrases_that_cannot_reach_the_support_are_not_counted(spark, monkeypatch):
    rows = [(f"a{i} b{i} c{i}. " * 3, "en") for i in range(800)] + [("the old mill", "en")] * 12
    seen, real = {}, collocations_module.counted
    monkeypatch.setattr(collocations_module, "counted", lambda docs, wanted: seen.update(wanted) or real(docs, wanted))
    got = collocations(spark.createDataFrame(rows, "text string, lang string"), 3, 10, 2000, 4)
    assert sorted(map(tuple, got.collect())) == plain_collocations(rows, 3, 10, 2000)
    assert {k: int(np.unpackbits(bits).sum()) for k, bits in seen.items()} == {2: 2, 3: 1}


def test_distinct_rows_of_codes():
    columns = [np.array(x) for x in ([1, 0, 1, 1, 0], [2, 0, 2, 3, 1])]
    for bounds in ([2, 4], [2, 1 << 62]):
        rows, n = collocations_module.distinct(columns, bounds)
        assert dict(zip(zip(*(x.tolist() for x in rows)), n.tolist())) == {(1, 2): 2, (0, 0): 1, (1, 3): 1, (0, 1): 1}
        assert [len(x) for x in collocations_module.distinct([x[:0] for x in columns], bounds)[0]] == [0, 0]


def test_scores_pass_64_bits(spark):
    rows = [(3_000_000_000_000, 3_000_000_000_001, 4_000_000_000_003), (7, 7, 9), (10**15, 10**15, 10**15)]
    got = spark.createDataFrame(rows, "a long, l long, r long").select("a", "l", "r", strength(F.col("a"), F.col("l"), F.col("r")).alias("s"))
    assert {(r.a, r.l, r.r, r.s) for r in got.collect()} == {(a, l, r, 1000000 * a * a // (l * r)) for a, l, r in rows}


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves, fanout):
    """The root and each leaf's siblings per level as (before, behind)."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        runs = [level[i : i + fanout] for i in range(0, len(level), fanout)]
        for i, p in enumerate(at):
            run, own = runs[p // fanout], p % fanout
            paths[i].append(("".join(run[:own]), "".join(run[own + 1 :])))
        level, at = [sha(*r) for r in runs], [p // fanout for p in at]
    return level[0], paths


def plain_manifest(rows, fanout=2):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, more=0):
        n = None if r[4] is None else r[4] + more
        return sha(*[field(v) for v in (r[0], r[3], r[2], n, r[1])])

    first, langs, out = (lambda v: (v is not None, v)), {r[2] for r in rows}, []
    trees = {}
    for lang in sorted(langs, key=lambda v: (v is not None, (v or "").encode())):
        mine = sorted((first(r[0]), leaf(r), r[0], tampered(r, leaf)) for r in rows if r[2] == lang)
        trees[lang] = (mine, *plain_tree([m[1] for m in mine], fanout))
    root, tops = plain_tree([t[1] for t in trees.values()], fanout)
    for (mine, subroot, paths), top in zip(trees.values(), tops):
        for (_, own, doc_id, shown), path in zip(mine, paths):
            node = shown or own
            for before, behind in path + top:
                node = sha(before, node, behind)
            out.append((doc_id, own, subroot, root, sha(*[a + b for a, b in path + top]), node, node == root))
    return Counter(out)


def tampered(r, leaf):
    shown = leaf(r, 1) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 else leaf(r)
    return shown if shown != leaf(r) else ""


def test_manifest_on_odd_rows(spark, odd):
    assert Counter(map(tuple, QUERIES["op12_manifest"](spark, odd).collect())) == plain_manifest(odd_documents())


def test_manifest_of_other_fanouts_and_sizes(spark):
    for n, fanout in ((1, 2), (2, 2), (9, 3), (65, 2), (40, 5), (37, 20)):
        rows = [(i, f"t{i}", ["b", "a", None][i % 3 if i % 7 else 0], "s", i) for i in range(n)]
        docs = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], DOCS).withColumn("root", F.lit("clash"))
        leaf = leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
        changed = leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text"))
        hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
        got = manifest(docs, leaf, F.col("lang"), F.col("doc_id"), F.when(hit, changed).otherwise(leaf), fanout)
        got = got.select("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
        assert Counter(map(tuple, got.collect())) == plain_manifest(rows, fanout)


def plain_components(rows, k, percent):
    """component_id per row by comparing all pairs that share a shingle."""
    sets = []
    for _, text in rows:
        w = WORD.findall(lower(text))
        sets.append({tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set())
    holders, top = defaultdict(list), list(range(len(rows)))
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in {(a, b) for h in holders.values() for x, a in enumerate(h) for b in h[x + 1 :]}:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * len(sets[a] | sets[b]):
            top[root(a)] = root(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return Counter((d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def test_minmax_on_odd_rows(spark, odd):
    got = QUERIES["op13_minmax"](spark, odd).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_components([r[:2] for r in odd_documents()], 4, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_minmax_finds_stars_chains_and_pairs_at_the_threshold(spark):
    random.seed(3)
    rows = []
    for base in range(12):
        words = [f"w{random.randint(0, 10**6)}" for _ in range(random.choice([5, 30, 120, 400]))]
        rows.append(" ".join(words))
        for copy in range(random.choice([2, 12, 40])):
            if base % 3 == 0:  # a chain: every copy is made of the one before
                words = list(words)
                words[random.randrange(len(words))] = f"n{copy}"
                rows.append(" ".join(words))
            else:  # a star, most copies near the threshold
                other = list(words)
                for _ in range(max(1, len(words) // random.choice([35, 40, 45]))):
                    other[random.randrange(len(words))] = f"n{random.randint(0, 10**6)}"
                rows.append(" ".join(other))
    rows = [(i * 7 % 1009, t) for i, t in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash"))
    got = near_duplicates(docs, k=4, percent=80).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_components(rows, 4, 80)


def test_minmax_signature_estimates_similarity():
    import numpy as np

    rng, constants = np.random.default_rng(1), permutation_constants(200)
    x = rng.integers(-(2**62), 2**62, 20_000)
    a, b = signature(x[:18_000], *constants), signature(x[2_000:], *constants)
    assert abs((a == b).mean() - 0.8) < 0.06
    assert (signature(x, *constants) == signature(np.concatenate([x[9_000:], x[:9_000]]), *constants)).all()
