"""Secrets found through an inverted index of trigrams."""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as op
from re import _parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, settle, table


@dataclass(frozen=True)
class Rule:
    """A pattern that Java and Python both read; a match is dropped if its `group` has under `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: Rules of the production query; the first three are the base ones.
RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud", r"AIza[0-9A-Za-z_-]{35,}"),
    Rule("payment", r"[rs]k_live_[0-9A-Za-z]{16,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
    Rule("url_login", r"[A-Za-z][A-Za-z0-9+.-]{0,15}://[^/\x20\x09-\x0D:@]{1,64}:[^/\x20\x09-\x0D:@]{1,64}@"),
)
#: Documents per block of the index, in ids.
BLOCK_BITS = 11
#: Readings of a pattern that are followed apart; further ones are read as "anything".
READINGS = 64


def readings(tree) -> list[str]:
    """What a parsed pattern can match, as literal pieces with \\0 for anything (also nothing) between them."""
    out = [""]
    for kind, value in tree:
        if kind is op.LITERAL:
            more = [chr(value)]
        elif kind is op.SUBPATTERN:
            more = readings(value[3])
        elif kind is op.BRANCH:
            more = [r for branch in value[1] for r in readings(branch)]
        elif kind is op.IN and all(k is op.LITERAL for k, _ in value) and len(value) <= 8:
            more = [chr(v) for _, v in value]
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            low, high, inner = value
            once = readings(inner)
            more = once if (low, high) == (1, 1) else [*once, ""] if (low, high) == (0, 1) else ["\0"] if low == 0 else [f"{r}\0" for r in once]
        elif kind is op.AT:
            more = [""]
        else:
            more = ["\0"]
        more = more if len(out) * len(more) <= READINGS else ["\0"]
        out = [a + b for a in out for b in more]
    return out


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """OR of ANDs of lower-case trigrams that every match holds; empty if some match may hold none."""
    clauses = set()
    for reading in readings(_parser.parse(pattern)):
        pieces = reading.lower().split("\0")
        clauses.add(frozenset(p[i : i + 3] for p in pieces for i in range(len(p) - 2)))
    if frozenset() in clauses:
        return []
    return sorted((c for c in clauses if not any(d < c for d in clauses)), key=sorted)


def postings(docs: DataFrame, trigrams: list[str], block_bits: int = BLOCK_BITS) -> DataFrame:
    """The inverted index: (block, trigram, ids) with the ids of a block's documents that hold the trigram.

    It holds the trigrams that the rules ask for. A block is a range of 2^block_bits ids, so no posting
    list grows with the corpus, however common its trigram is.
    """
    every = F.array(*[F.lit(t) for t in trigrams])
    held = let(F.lower("text"), lambda low: F.filter(every, lambda t: F.contains(low, t)))
    rows = docs.where("doc_id IS NOT NULL").select("doc_id", F.explode(held).alias("trigram"))
    block = F.shiftright("doc_id", block_bits).alias("block")
    return rows.groupBy(block, "trigram").agg(F.collect_set("doc_id").alias("ids"))


def candidates(index: DataFrame, queries: dict[int, list[frozenset[str]]]) -> DataFrame:
    """(doc_id, rules): the bits of the rules whose trigram query the document meets, by set algebra on postings."""
    lists = F.map_from_entries(F.collect_list(F.struct("trigram", "ids")))
    blocks = index.groupBy("block").agg(lists.alias("lists"))  # one list per trigram of the rules
    none = F.array().cast("array<bigint>")

    def ids(clause: frozenset[str]) -> Column:
        out = None
        for t in sorted(clause):
            one = F.coalesce(F.element_at("lists", F.lit(t)), none)
            out = one if out is None else F.array_intersect(out, one)
        return out

    def marked(union: Column, bit: int) -> Column:
        return F.transform(union, lambda i: F.struct(i.alias("doc_id"), F.lit(1 << bit).cast("long").alias("rules")))

    met = []
    for bit, clauses in queries.items():
        union = None
        for clause in clauses:
            union = ids(clause) if union is None else F.array_union(union, ids(clause))
        met.append(marked(union, bit))
    return blocks.select(F.inline(F.concat(*met))).groupBy("doc_id").agg(F.bit_or("rules").alias("rules"))


def spans_of(text: Column, rule: Rule, number: int) -> Column:
    """All matches of a rule, leftmost and not overlapping, as (start, rule, end) in code points.

    The lengths of the pieces between the matches and of the matches themselves add up to the places.
    """
    pieces = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    tested = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    steps = F.arrays_zip(
        F.transform(pieces, lambda p: F.length(p)).alias("gap"), F.transform(whole, lambda m: F.length(m)).alias("size"),
        F.transform(tested, lambda m: F.length(m)).alias("tested"),
    )
    empty = F.array().cast("array<struct<start:int,rule:int,end:int>>")

    def step(a: Column, s: Column) -> Column:
        start = a["at"] + s["gap"]
        end = start + F.coalesce(s["size"], F.lit(0))
        span = F.array(F.struct(start.alias("start"), F.lit(number).alias("rule"), end.alias("end")))
        keep = s["size"].isNotNull() & (s["tested"] >= rule.least)
        return F.struct(end.alias("at"), F.when(keep, F.concat(a["out"], span)).otherwise(a["out"]).alias("out"))

    found = F.aggregate(steps, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda a: a["out"])
    return F.when(F.rlike(text, F.lit(rule.pattern)), found).otherwise(empty)


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, block_bits: int = BLOCK_BITS) -> DataFrame:
    """docs(doc_id, text, ...): append `spans`, an array of (start, rule, end) sorted by start, then rule.

    Rules with a trigram query look only at the documents that the index names; rules without one read every
    document. Ids may repeat (the index then names all their rows, the patterns decide). Rows with a null id
    are not in the index and all rules read them. A null text counts as empty. An input column called
    `spans` is replaced.
    """
    docs = docs.drop("spans")
    queries = {i: trigram_query(r.pattern) for i, r in enumerate(rules)}
    indexed = {i: q for i, q in queries.items() if q}
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs
    bits = F.lit(0).cast("long")
    if indexed:
        trigrams = sorted({t for q in indexed.values() for clause in q for t in clause})
        found = candidates(postings(docs.select("doc_id", "text"), trigrams, block_bits), indexed)
        found = settle(found.select(F.col("doc_id").alias("__id"), F.col("rules").alias("__rules")), "secret-candidates")
        rows = docs.join(found, docs["doc_id"] == found["__id"], "left")
        bits = F.coalesce("__rules", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(F.lit(0)).cast("long"))
    empty = F.array().cast("array<struct<start:int,rule:int,end:int>>")
    parts = []
    for i, rule in enumerate(rules):
        spans = spans_of(text, rule, i)
        parts.append(F.when(F.getbit(bits, F.lit(i)) == 1, spans).otherwise(empty) if i in indexed else spans)
    return rows.withColumn("spans", F.array_sort(F.concat(*parts))).drop("__id", "__rules")


def listed(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rule"]), s["start"], s["end"])), ",")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_secrets(docs).select("doc_id", "spans")

    def number(i: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["rule"] == i)).cast("long")

    counts = {f"n_{r.kind}": number(i) for i, r in enumerate(RULES[:3])}
    base = F.filter("spans", lambda s: s["rule"] < 3)
    return found.select(
        "doc_id", *[c.alias(n) for n, c in counts.items()], F.sha2(listed(base, RULES), 256).alias("base_sha256"),
        listed(F.col("spans"), RULES).alias("spans"),
    )


def _sql_spans(number: int, rule: Rule) -> str:
    pattern = rule.pattern.replace("(?i:", "(")
    if "(?i:" in rule.pattern:  # the SQL engine's folding of case goes beyond ASCII
        head, tail = pattern[1:].split(")", 1)
        pattern = "(?:" + re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", head) + ")" + tail
    quoted = pattern.replace("'", "''")
    return f"""SELECT k, {number} AS rule, g, s, t FROM (
      SELECT k, string_split_regex(text, '{quoted}') AS gaps, regexp_extract_all(text, '{quoted}', 0) AS whole,
        regexp_extract_all(text, '{quoted}', {rule.group}) AS tested FROM d WHERE regexp_matches(text, '{quoted}')
    ), LATERAL (SELECT unnest(list_transform(range(1, len(whole) + 1), lambda i: {{
      'g': CAST(list_sum(list_transform(gaps[1:i], lambda p: length(p))) AS BIGINT)
           + CAST(coalesce(list_sum(list_transform(whole[1:i - 1], lambda p: length(p))), 0) AS BIGINT),
      's': length(whole[i]), 't': length(tested[i])}}), recursive := true)) WHERE t >= {rule.least}"""


OP3_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
s AS ({" UNION ALL ".join(_sql_spans(i, r) for i, r in enumerate(RULES))}),
named AS (SELECT k, rule, g, {str([r.kind for r in RULES])}[rule + 1] || ':' || g || ':' || (g + s) AS span FROM s),
listed AS (
  SELECT k, count(*) FILTER (WHERE rule = 0) AS n_assign, count(*) FILTER (WHERE rule = 1) AS n_access,
    count(*) FILTER (WHERE rule = 2) AS n_hex, string_agg(span, ',' ORDER BY g, rule) FILTER (WHERE rule < 3) AS base,
    string_agg(span, ',' ORDER BY g, rule) AS spans
  FROM named GROUP BY k
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN listed USING (k)
"""
