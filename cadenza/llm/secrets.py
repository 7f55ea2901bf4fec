"""Secret scans through a trigram inverted index, with DataFrame functions only.

Each rule's regular expression gives a Boolean trigram query (an AND of ORs of trigram sets over
the lower-cased text). The index lists, for every trigram that some rule asks for, the documents
whose texts hold it. It is cut into segments by the partition that was scanned, so that a posting
list is bounded by a partition's documents. Per segment a rule's posting lists are intersected, and
united over alternatives. Only ids travel: the candidates are broadcast to a second scan of the texts
if they are few, and only beyond BROADCAST_IDS of them texts are shuffled to meet them. There the
expression itself verifies them. Rules without a mandatory trigram scan every text.

Spans are code points, end exclusive, leftmost and non-overlapping within a kind.

Defined results: a null or empty text has no spans; a row without doc_id is scanned by every rule;
repeated rows give repeated results; a very long text is one row, searched whole, at a cost little above
linear in its length and in its matches; spans of equal start
follow the rules' order; an empty table gives an empty table; columns other than doc_id and text are
ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, plain_docs, spread, unpacked, written

_parser, _code = re._parser, re._constants
#: Candidates (an id and at most ten short names each, some 100 bytes) that may be broadcast.
BROADCAST_IDS = 500_000
#: Characters of a chunk of a text that is redacted.
CHUNK = 4096


@dataclass(frozen=True)
class Rule:
    """A match counts if ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


#: In the order in which kinds of equal start are listed.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, True),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32, True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{20,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{30,}"),
    Rule("live", r"sk_(live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
    Rule("userinfo", r"://[^\s:/@]+:[^\s:/@]+@"),
)

Query = frozenset  # of clauses; a clause is a frozenset of alternatives; an alternative is a frozenset of trigrams


def trigram_query(pattern: str, widest: int = 32) -> Query:
    """Clauses that every match meets, over lower-cased text; an empty query holds for any text."""
    clauses: set[frozenset[frozenset[str]]] = set()

    def close(texts: set[str]) -> None:
        sets = [frozenset(t[i : i + 3] for i in range(len(t) - 2)) for t in texts]
        if sets and all(sets):
            clauses.add(frozenset(s for s in sets if not any(other < s for other in sets)))

    def literal_sets(node) -> set[str] | None:
        """All strings of a small sub-expression; None if they are too many or unbounded."""
        found = {""}
        for kind, value in node:
            if kind is _code.LITERAL:
                own = {chr(value).lower()}
            elif kind is _code.IN and all(k in (_code.LITERAL, _code.RANGE) for k, _ in value):
                own = set()
                for k, v in value:
                    own |= {chr(v).lower()} if k is _code.LITERAL else {chr(c).lower() for c in range(v[0], v[1] + 1)}
                if len(own) > 6:
                    return None
            elif kind is _code.SUBPATTERN:
                own = literal_sets(value[3])
            elif kind is _code.BRANCH:
                parts = [literal_sets(b) for b in value[1]]
                own = None if any(p is None for p in parts) else set().union(*parts)
            elif kind is _code.MAX_REPEAT and value[1] <= 3:
                inner = literal_sets(value[2])
                own = None if inner is None else {"".join(c) for n in range(value[0], value[1] + 1) for c in itertools.product(inner, repeat=n)}
            else:
                own = None
            if own is None or len(found) * len(own) > widest:
                return None
            found = {a + b for a in found for b in own}
        return found

    def walk(node) -> None:
        run: set[str] = {""}
        for item in node:
            own = literal_sets([item])
            if own is not None and len(run) * len(own) <= widest:
                run = {a + b for a in run for b in own}
                continue
            close(run)
            run = own if own is not None else {""}
            if own is None and item[0] is _code.SUBPATTERN:
                walk(item[1][3])
            elif own is None and item[0] is _code.MAX_REPEAT and item[1][0] > 0:
                walk(item[1][2])
        close(run)

    walk(_parser.parse(pattern))
    return frozenset(clauses)


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(segment, trigram, ids): the part of the inverted index that the rules can ask for."""
    low = docs.where("doc_id is not null").select("doc_id", F.lower("text").alias("low"))  # lowered once, not per trigram
    held = F.filter(F.array(*(F.lit(t) for t in trigrams)), lambda t: F.contains(F.col("low"), t))
    placed = low.select("doc_id", F.explode(held).alias("trigram"), F.spark_partition_id().alias("segment"))
    return placed.groupBy("segment", "trigram").agg(F.collect_set("doc_id").alias("ids"))  # of one scanned partition


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, kinds): the rules whose trigram query a document meets, from intersected posting lists."""
    none = F.array().cast("array<bigint>")
    segments = index.groupBy("segment").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "ids"))).alias("lists"))

    def meeting(query: Query) -> Column:
        ids = lambda trigram: F.coalesce(F.try_element_at("lists", F.lit(trigram)), none)
        clause = lambda alternatives: reduce(F.array_union, (reduce(F.array_intersect, map(ids, sorted(a))) for a in sorted(alternatives, key=sorted)))
        return reduce(F.array_intersect, map(clause, sorted(query, key=lambda c: sorted(map(sorted, c)))))

    asked = [(r, q) for r in rules if (q := trigram_query(r.pattern))]
    found = F.array(*(F.struct(F.lit(r.kind).alias("kind"), meeting(q).alias("ids")) for r, q in asked))
    each = segments.select(F.inline(found)).select("kind", F.explode("ids").alias("doc_id"))
    return each.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))  # no more than there are rules


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def before_each(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """For every number of an array<int>, ``step`` carried from 0 over all numbers before it.

    The array is cut into about as many parts as a part has numbers: appending to an array copies it, so
    one pass over n numbers would take n x n steps. Here it is n times the root of n.
    """
    none = F.array().cast("array<int>")

    def part(numbers: Column, start: Column) -> Column:
        return F.aggregate(numbers, F.struct(start.alias("at"), none.alias("out")), lambda s, x: F.struct(step(s["at"], x).alias("at"), F.array_append(s["out"], s["at"]).alias("out")))

    def parts(whole: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(whole))).cast("int")
        cuts = F.transform(F.sequence(F.lit(0), F.floor((F.size(whole) - 1) / width).cast("int")), lambda i: F.slice(whole, i * width + 1, width))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<int>>").alias("out"))
        joined = lambda s, x: bound(part(x, s["at"]), lambda p: F.struct(p["at"].alias("at"), F.array_append(s["out"], p["out"]).alias("out")))
        return F.when(F.size(whole) > 0, F.aggregate(cuts, start, joined, lambda s: F.flatten(s["out"]))).otherwise(none)

    return bound(values, parts)


def rule_spans(text: Column, rule: Rule, order: int) -> Column:
    """array<struct<start, order, end>> of the rule's matches in a text."""
    # a text is cut at its matches: piece 0, match 0, piece 1, ...
    matches, pieces = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), F.split(text, rule.pattern, -1)

    def measured(pair: Column) -> Column:
        weighed = F.length(F.regexp_extract(pair["match"], rule.pattern, rule.group)) if rule.group else F.length(pair["match"])
        return F.struct(F.length(pair["piece"]).alias("gap"), F.length(pair["match"]).alias("wide"), (weighed >= rule.least).alias("counts"))

    def placed(sizes: Column) -> Column:
        starts = before_each(F.transform(sizes, lambda x: x["gap"] + x["wide"]), lambda at, x: at + x)
        spans = F.zip_with(sizes, starts, lambda x, at: F.struct((at + x["gap"]).alias("start"), F.lit(order).alias("order"), (at + x["gap"] + x["wide"]).alias("end"), x["counts"].alias("counts")))
        return F.transform(F.filter(spans, lambda s: s["counts"]), lambda s: F.struct(s["start"].alias("start"), s["order"].alias("order"), s["end"].alias("end")))

    pairs = F.arrays_zip(pieces.alias("piece"), matches.alias("match"))  # one more piece than matches
    sizes = F.filter(F.transform(pairs, lambda p: F.when(p["match"].isNotNull(), measured(p))), lambda x: x.isNotNull())
    return bound(sizes, placed)


def covered(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with ``spans`` (sorted by start) replaced by ``mark``, overlapping ones by one.

    A substring is found by counting characters from the start, so the text is cut once into chunks of CHUNK
    characters, and what lies between two spans is taken from the chunks that hold it.
    """

    def between(chunks: Column, a: Column, b: Column) -> Column:
        first, last = F.floor(a / CHUNK).cast("int"), F.floor(b / CHUNK).cast("int")
        one = F.substring(F.get(chunks, first), a % CHUNK + 1, b - a)
        inner = F.array_join(F.slice(chunks, first + 2, F.greatest(F.lit(0), last - first - 1)), "")
        several = F.concat(F.substring(F.get(chunks, first), a % CHUNK + 1, F.lit(CHUNK)), inner, F.coalesce(F.substring(F.get(chunks, last), F.lit(1), b % CHUNK), F.lit("")))
        return F.when(b <= a, F.lit("")).when(first == last, one).otherwise(several)

    def cut(own: Column) -> Column:
        done = before_each(F.transform(own, lambda s: s["end"]), F.greatest)
        gaps = F.zip_with(own, done, lambda s, at: F.struct(at.alias("a"), s["start"].alias("b")))
        fresh = F.filter(gaps, lambda g: g["b"] >= g["a"])
        end = F.array_max(F.transform(own, lambda s: s["end"]))
        joined = lambda chunks: F.concat(F.array_join(F.transform(fresh, lambda g: F.concat(between(chunks, g["a"], g["b"]), F.lit(mark))), ""), between(chunks, end, F.length(text)))
        return bound(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)), joined)

    return bound(spans, cut)


def scanned(docs: DataFrame, rules: tuple[Rule, ...] = RULES, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """``docs`` (doc_id, text and more) with ``secret_spans``, sorted by start and then by the rules' order."""
    trigrams = sorted({t for r in rules for c in trigram_query(r.pattern) for a in c for t in a})
    asked = {r.kind for r in rules if trigram_query(r.pattern)}
    kinds = written(candidates(postings(spread(docs.select("doc_id", "text")), trigrams), rules).select(F.col("doc_id").alias("secret_doc"), F.col("kinds").alias("secret_kinds")), "candidates")
    few = kinds.count() <= broadcast_ids
    joined = spread(docs).join(kinds.hint("broadcast" if few else "merge"), F.col("doc_id") == F.col("secret_doc"), "left")
    empty = F.array().cast("array<struct<start:int,order:int,end:int>>")
    found = []
    for order, rule in enumerate(rules):
        spans = F.when(F.col("text").rlike(rule.pattern), rule_spans(F.col("text"), rule, order)).otherwise(empty)
        if rule.kind in asked:
            spans = F.when(F.col("doc_id").isNull() | F.coalesce(F.array_contains("secret_kinds", rule.kind), F.lit(False)), spans).otherwise(empty)
        found.append(spans)
    return joined.withColumn("secret_spans", F.array_sort(F.concat(*found))).drop("secret_doc", "secret_kinds")


def _listed(spans: Column, rules: tuple[Rule, ...]) -> Column:
    names = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["order"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans)."""
    base = [i for i, r in enumerate(rules) if r.base]
    of_base = F.filter("secret_spans", lambda s: s["order"].isin(base))
    count = lambda i: F.size(F.filter("secret_spans", lambda s: s["order"] == i)).cast("long")
    found = scanned(plain_docs(documents), rules)
    return found.select(
        "doc_id", *(count(i).alias(f"n_{rules[i].kind}") for i in base), F.sha2(_listed(of_base, rules), 256).alias("base_sha256"), _listed(F.col("secret_spans"), rules).alias("spans")
    )


def redact(documents: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """``documents`` with every secret replaced by ``mark`` (overlapping spans by one) and n_chars set anew where one was."""
    found = scanned(packed(documents), rules).withColumn("clean", F.when(F.size("secret_spans") > 0, covered(F.col("text"), F.col("secret_spans"), mark)).otherwise(F.col("text")))
    new = {"text": F.col("clean")}
    if "n_chars" in documents.columns:
        kind = dict(documents.dtypes)["n_chars"]
        new["n_chars"] = F.when(F.size("secret_spans") > 0, F.length("clean").cast(kind)).otherwise(F.col("kept.n_chars"))
    return unpacked(found, documents.columns, **new)


def _oracle() -> str:
    """DuckDB: cut each text at a rule's matches and add up the lengths."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    found = " UNION ALL ".join(
        f"SELECT doc_id, t, {i} AS kind_order, {quoted(r.kind)} AS kind, {str(r.base).lower()} AS base, regexp_extract_all(t, {quoted(r.pattern)}) AS m, "
        f"regexp_extract_all(t, {quoted(r.pattern)}, {r.group}) AS g, string_split_regex(t, {quoted(r.pattern)}) AS p, {r.least} AS least FROM d WHERE regexp_matches(t, {quoted(r.pattern)})"
        for i, r in enumerate(RULES)
    )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), f AS ({found}),
u AS (SELECT doc_id, kind_order, kind, base, least, unnest(m) AS m, unnest(g) AS g, unnest(p[:len(m)]) AS p, unnest(range(1, len(m) + 1)) AS i FROM f),
s AS (
  SELECT *, sum(length(p)) OVER w + coalesce(sum(length(m)) OVER (PARTITION BY doc_id, kind_order ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s0
  FROM u WINDOW w AS (PARTITION BY doc_id, kind_order ORDER BY i)
),
k AS (SELECT doc_id, kind, kind_order, base, s0::BIGINT AS s0, (s0 + length(m))::BIGINT AS s1 FROM s WHERE length(g) >= least),
a AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || s0 || ':' || s1, ',' ORDER BY s0, kind_order) FILTER (base) AS b, string_agg(kind || ':' || s0 || ':' || s1, ',' ORDER BY s0, kind_order) AS spans FROM k GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (doc_id)
"""


ORACLE = _oracle()
