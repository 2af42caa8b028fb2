"""Secret scans over a trigram index, in DataFrame functions only."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import text_or_empty
from riskloom.session import pin

MAX_EXACT = 64  # strings followed at once while deriving trigrams


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``group`` (0: all) has to have ``least`` characters."""

    kind: str
    regex: str
    group: int = 0
    least: int = 1


def _either(words: str) -> str:
    """Letters in either case, spelt out so that every regex engine reads the same."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


# The base kinds in the order in which equal starts are listed, then added ones.
# A maximal run of at least n characters is the same match as the run itself, checked for n
# afterwards, so the kinds that are one run carry their length in the pattern.
NAMES = "|".join(_either(w) for w in ("password", "passwd", "secret", "token")) + "|" + _either("api") + "_?" + _either("key")
RULES = (
    Rule("assign", rf"""({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
BASE_KINDS = ("assign", "access", "hex")


# From a regex to the trigrams that each of its matches contains -----------------
# A query is ("and", queries) | ("or", queries) | a trigram; ("and", ()) holds always.

ALWAYS = ("and", ())


def _and(*queries):
    flat = []
    for q in queries:
        flat += q[1] if isinstance(q, tuple) and q[0] == "and" else [q]
    flat = tuple(dict.fromkeys(flat))
    return flat[0] if len(flat) == 1 else ("and", flat)


def _or(*queries):
    if any(q == ALWAYS for q in queries):
        return ALWAYS
    flat = dict.fromkeys(queries)
    # An arm that asks for more than another adds nothing.
    flat = tuple(q for q in flat if not any(p != q and _asks(p) < _asks(q) for p in flat))
    return flat[0] if len(flat) == 1 else ("or", flat)


def _asks(query) -> frozenset:
    return frozenset([query] if isinstance(query, str) else query[1] if query[0] == "and" else [query])


def _of_strings(strings: set[str]):
    """Each match contains one of these strings."""
    if not strings or min(map(len, strings)) < 3:
        return ALWAYS
    return _or(*[_and(*[s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def trigram_query(regex: str):
    """The Boolean query over lower-cased trigrams that holds for every match of ``regex``.

    The pattern's pieces are read from left to right. As long as a piece stands for few
    strings they are appended to the strings followed so far; a piece that stands for many
    ends them, and they add "one of them occurs" to the query.
    """

    def walk(items):
        exact, query = {""}, ALWAYS

        def flush():
            nonlocal exact, query
            query, exact = _and(query, _of_strings(exact)), {""}

        for op, arg in items:
            strings, inner = piece(str(op), arg)
            if strings is not None and len(strings) * len(exact) <= MAX_EXACT:
                exact = {a + b for a, b in product(exact, strings)}
            else:
                flush()
                query = _and(query, inner if strings is None else _of_strings(strings))
        return exact, query

    def piece(op, arg):
        """(the strings it stands for or None, what it implies otherwise)."""
        if op == "LITERAL":
            return {chr(arg).lower()}, ALWAYS
        if op == "IN":
            chars = [chr(a).lower() for o, a in arg if str(o) == "LITERAL"]
            return ({*chars}, ALWAYS) if len(chars) == len(arg) else (None, ALWAYS)
        if op == "SUBPATTERN":
            exact, query = walk(arg[-1])
            return (exact, ALWAYS) if query == ALWAYS else (None, _and(query, _of_strings(exact)))
        if op == "BRANCH":
            arms = [walk(a) for a in arg[1]]
            if all(q == ALWAYS for _, q in arms):
                return set().union(*[e for e, _ in arms]), ALWAYS
            return None, _or(*[_and(q, _of_strings(e)) for e, q in arms])
        if op == "MAX_REPEAT":
            low, high, body = arg
            exact, query = walk(body)
            if high == 1 and query == ALWAYS:
                return exact | {""}, ALWAYS
            return None, (_and(query, _of_strings(exact)) if low else ALWAYS)
        return None, ALWAYS

    exact, query = walk(re._parser.parse(regex))
    return _and(query, _of_strings(exact))


def trigrams_of(query) -> set[str]:
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


def holds(query, present: Column) -> Column:
    """The query over an array of the trigrams that a text has."""
    if isinstance(query, str):
        return F.array_contains(present, query)
    parts = [holds(q, present) for q in query[1]]
    if not parts:
        return F.lit(True)
    return reduce(Column.__and__ if query[0] == "and" else Column.__or__, parts)


def build_index(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (trigram, content) of the trigrams that some rule asks for."""
    # Lower-casing more than A-Z can only admit more; the lambda's variable holds the
    # lowered text, which is made once and not once per trigram.
    wanted = F.array(*[F.lit(t) for t in trigrams])
    own = F.transform(F.array(F.lower("text")), lambda low: F.filter(wanted, lambda t: F.contains(low, t)))
    return texts.select("content", F.explode(F.get(own, F.lit(0))).alias("trigram"))


def candidates(index: DataFrame, queries: dict) -> DataFrame:
    """(content, kinds): postings intersected per text by each rule's query."""
    present = index.groupBy("content").agg(F.collect_set("trigram").alias("present"))
    kinds = F.array_compact(F.array(*[F.when(holds(q, F.col("present")), F.lit(k)) for k, q in queries.items()]))
    return present.select("content", kinds.alias("kinds")).filter(F.size("kinds") > 0)


PART = "array<struct<rank: int, kind: string, least: int, at: int, gap: int, own: int, kept: int>>"


def parts_of(rule: Rule, rank: int, text: Column) -> Column:
    """The lengths of a rule's matches in order, and of what precedes and what counts of each.

    Pieces between leftmost non-overlapping matches and the matches themselves alternate,
    so their lengths added up give each place. Each list is made once and zipped.
    """
    pieces, whole = F.split(text, rule.regex, -1), F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0))
    kept = whole if rule.group == 0 else F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group))
    return F.transform(
        F.arrays_zip(pieces, whole, kept),
        lambda z, i: F.struct(
            F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), F.lit(rule.least).alias("least"), i.alias("at"),
            F.length(z["0"]).alias("gap"), F.length(z["1"]).alias("own"), F.length(z["2"]).alias("kept"),
        ),
    )


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts and places of secrets in every whole text: n_<base kind>, base_sha256, spans.

    Each rule's regex gives a Boolean query over trigrams. The inverted index holds the
    postings of exactly those trigrams; postings are intersected per text, and only texts
    that a query admits are verified by its regex. A rule without mandatory trigrams scans
    all texts. Texts are known by the digest of their content, so copies are indexed and
    verified once, and the hot text of a copied page is one row before the join.

    A null text is an empty one: counts 0, no spans and the digest of an empty list.
    Repeated rows and null ids keep their rows; an empty table gives an empty one; further
    columns are ignored.
    """
    order = {r.kind: i for i, r in enumerate(rules)}
    queries = {r.kind: trigram_query(r.regex) for r in rules}
    indexed = {k: q for k, q in queries.items() if q != ALWAYS}
    texts = docs.select("doc_id", text_or_empty().alias("text")).withColumn("content", F.md5("text"))
    wanted = sorted(set().union(*map(trigrams_of, indexed.values()))) if indexed else []
    found = pin(candidates(build_index(texts, wanted), indexed), "secret-candidates")

    def located(kinds: list[Rule], frame: DataFrame, admitted: Column | None) -> DataFrame:
        lists = []
        for r in kinds:
            test = F.col("text").rlike(r.regex)
            own = parts_of(r, order[r.kind], F.col("text"))
            lists.append(F.when(test if admitted is None else F.array_contains(admitted, r.kind) & test, own).otherwise(F.array().cast(PART)))
        return frame.select("content", F.inline(F.concat(*lists)))

    by_index = located([r for r in rules if r.kind in indexed], texts.join(found, "content"), F.col("kinds"))
    full = located([r for r in rules if r.kind not in indexed], texts, None)
    # Copies of a text have the same parts; the piece behind the last match has no match.
    parts = by_index.unionAll(full).filter(F.col("own").isNotNull()).dropDuplicates(["content", "rank", "at"])
    upto = F.sum(F.col("gap") + F.col("own")).over(Window.partitionBy("content", "rank").orderBy("at"))
    spot = F.struct((F.col("end") - F.col("own")).cast("int").alias("start"), "rank", "kind", F.col("end").cast("int").alias("end"))
    merged = (
        parts.repartition("content").withColumn("end", upto)
        .filter(F.col("kept") >= F.col("least"))
        .groupBy("content")
        .agg(F.array_sort(F.collect_list(spot)).alias("found"))
    )
    result = pin(merged, "secret-spans")
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    spans = F.coalesce(F.col("found"), F.expr("cast(array() AS array<struct<start: int, rank: int, kind: string, end: int>>)"))
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))
    of_kind = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    return (
        texts.select("doc_id", "content")
        .join(result, "content", "left")
        .select(
            "doc_id",
            *[of_kind(k).alias(f"n_{k}") for k in BASE_KINDS],
            F.sha2(listed(base), 256).alias("base_sha256"),
            listed(spans).alias("spans"),
        )
    )


def secrets_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The same spans in DuckDB: pieces and matches zipped and summed."""
    parts = []
    for i, r in enumerate(rules):
        x = r.regex.replace("'", "''")
        parts.append(
            f"""SELECT k, '{r.kind}' AS kind, {i} AS rank, start, start + own AS fin FROM (
  SELECT k, own, kept, (sum(gap + own) OVER (PARTITION BY k ORDER BY i) - own)::BIGINT AS start FROM (
    SELECT k, i, length(p[i]) AS gap, length(m[i]) AS own, length(g[i]) AS kept FROM (
      SELECT k, p, m, g, unnest(range(1, len(m) + 1)) AS i FROM (
        SELECT k, string_split_regex(text, '{x}') AS p, regexp_extract_all(text, '{x}') AS m,
               regexp_extract_all(text, '{x}', {r.group}) AS g
        FROM d WHERE regexp_matches(text, '{x}'))))) WHERE kept >= {r.least}"""
        )
    listed = "coalesce(string_agg(kind || ':' || start || ':' || fin, ',' ORDER BY start, rank){f}, '')"
    base = " FILTER (rank < 3)"
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE_KINDS)
    return f"""WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
s AS ({" UNION ALL ".join(parts)})
SELECT any_value(doc_id) AS doc_id, {counts}, sha256({listed.format(f=base)}) AS base_sha256, {listed.format(f="")} AS spans
FROM d LEFT JOIN s USING (k) GROUP BY k"""
