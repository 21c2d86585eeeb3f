r"""Secret scans over a trigram inverted index.

Every rule is a regular expression. Its Boolean trigram query (alternatives of sets of trigrams
that any match must hold) is derived from the expression itself. The index has a posting list of
document keys for each trigram that some query names, split into blocks of documents so that no
list outgrows a bound; the lists of each alternative are intersected block by block, and only the
candidates are verified by the expression. Rules without mandatory trigrams scan every text.

Kinds: assign, access, hex (the base), and pem, github, slack, jwt. Matches are leftmost and do not
overlap within a kind; a kind may ask for a least length of a group, and matches that fail it are
dropped after they have taken their characters.

DataFrame functions only. Defined cases: null or empty text: no spans. Null ids: a row each, their
text's hash is the key. Repeated ids: a row each; they share candidates, and verification decides.
Empty table: no rows. Extra columns are not read.
"""
from __future__ import annotations

import itertools
import math
from dataclasses import dataclass
from re import _parser as parser  # the expression's syntax tree

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from caresight.llm.common import column, table

#: Documents per block of the index; alternatives that a query may have.
BLOCK, ALTERNATIVES = 8192, 8


@dataclass(frozen=True)
class Rule:
    """An expression; ``group`` must hold ``least`` characters or the match is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


BASE = [
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}"),  # as runs of [0-9a-f]+ are maximal, the short ones need not be found first
]
MORE = [
    Rule("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
]
RULES = BASE + MORE


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives of lower-case trigrams, one of which any match holds in full; None: no such."""
    Found = tuple[str, frozenset[str]]  # the literal run that ends here, the trigrams before it

    def broken(states: set[Found]) -> set[Found]:
        return {("", seen | {run[i:i + 3] for i in range(len(run) - 2)}) for run, seen in states}

    def walk(states: set[Found], nodes) -> set[Found]:
        for op, arg in nodes:
            name = str(op)
            if name == "LITERAL":
                states = {(run + chr(arg).lower(), seen) for run, seen in states}
            elif name == "IN" and len(arg) * len(states) <= ALTERNATIVES and all(str(o) == "LITERAL" for o, _ in arg):
                states = {(run + chr(c).lower(), seen) for run, seen in states for _, c in arg}
            elif name == "SUBPATTERN":
                states = walk(states, arg[3])
            elif name == "BRANCH":
                states = set().union(*(walk(states, b) for b in arg[1]))
            elif name == "MAX_REPEAT" and tuple(arg[:2]) == (0, 1):
                more = states | walk(states, arg[2])
                states = more if len(more) <= ALTERNATIVES else broken(states)
            elif name == "MAX_REPEAT" and arg[0] > 0:
                states = broken(walk(states, arg[2]))
            elif name != "AT":
                states = broken(states)
        return states

    ways = {seen for _, seen in broken(walk({("", frozenset())}, parser.parse(pattern)))}
    if frozenset() in ways:
        return None
    return sorted((w for w in ways if not any(o < w for o in ways)), key=sorted)


def candidates(docs: DataFrame, rules: list[Rule]) -> DataFrame | None:
    """key, kinds (bits by position in ``rules``) of the rows (key, text) that the index leaves to verify."""
    ways = [(k, way) for k, r in enumerate(rules) for way in trigram_query(r.pattern) or []]
    if not ways:
        return None
    grams = sorted(set().union(*(way for _, way in ways)))
    users = F.create_map(*itertools.chain.from_iterable(
        (F.lit(i), F.array(*[F.lit(w) for w, (_, way) in enumerate(ways) if g in way])) for i, g in enumerate(grams)))
    sizes, kinds = (F.array(*[F.lit(x) for x in xs]) for xs in ([len(way) for _, way in ways], [1 << k for k, _ in ways]))
    blocks = max(1, math.ceil(docs.count() / BLOCK))

    lower = docs.select("key", F.lower("text").alias("text"))
    held = F.filter(F.array(*[F.when(F.contains("text", F.lit(g)), i) for i, g in enumerate(grams)]), lambda x: x.isNotNull())
    index = (lower.select("key", F.explode(held).alias("gram"))
             .groupBy("gram", F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block")).agg(F.collect_set("key").alias("postings")))
    lists = (index.select("block", "postings", F.explode(F.element_at(users, F.col("gram"))).alias("way"))
             .groupBy("way", "block").agg(F.collect_list("postings").alias("lists"))
             .where(F.size("lists") == F.get(sizes, F.col("way"))))
    both = F.aggregate("lists", F.get("lists", F.lit(0)), lambda a, b: F.array_intersect(a, b))
    return (lists.select(F.explode(both).alias("key"), F.get(kinds, F.col("way")).alias("kind"))
            .groupBy("key").agg(F.bit_or("kind").alias("kinds")))


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """Array of (start, kind, end) of a rule's matches, in code points."""
    rx = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, rx, F.lit(0))
    parts = F.arrays_zip(F.split(text, rule.pattern).alias("gap"), found.alias("hit"),
                         (F.regexp_extract_all(text, rx, F.lit(rule.group)) if rule.group else found).alias("part"))
    kind = "array<struct<s:int,k:int,e:int,n:int>>"

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
            start.alias("s"), F.lit(number).alias("k"), end.alias("e"), F.length(x["part"]).alias("n")))).alias("out"))

    placed = F.aggregate(F.filter(parts, lambda x: x["hit"].isNotNull()), F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out")), step)["out"]
    kept = F.filter(placed, lambda x: x["n"] >= rule.least)
    return F.when(F.size(found) > 0, F.transform(kept, lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"))))


def secrets(docs: DataFrame, rules: list[Rule] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, found (array of start, kind, end, by start and then kind; kinds are numbers of ``rules``)."""
    own, body = column(doc_id), F.coalesce(column(text).cast("string"), F.lit(""))
    read = docs.select(own.alias("doc_id"), body.alias("text"), F.coalesce(own, F.xxhash64(body)).alias("key"))
    left = candidates(read.select("key", "text"), rules)
    joined = read.join(left, "key", "left") if left is not None else read.withColumn("kinds", F.lit(0))
    kinds, empty = F.coalesce("kinds", F.lit(0)), F.array().cast("array<struct<s:int,k:int,e:int>>")
    found = []
    for number, rule in enumerate(rules):
        spans = _spans(F.col("text"), rule, number)
        verify = F.lit(True) if trigram_query(rule.pattern) is None else kinds.bitwiseAND(F.lit(1 << number)) != 0
        found.append(F.coalesce(F.when(verify, spans), empty))
    return joined.select("doc_id", F.sort_array(F.concat(*found)).alias("found"))


def _listed(found: Column, names: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"], x["e"])), ",")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(table(spark, sf_dir, "documents"))
    names, all_of = F.array(*[F.lit(r.kind) for r in RULES]), F.col("found")
    base = F.filter(all_of, lambda x: x["k"] < len(BASE))
    of_kind = F.transform(all_of, lambda x: x["k"])
    counts = [(F.size(all_of) - F.size(F.array_remove(of_kind, k))).cast("long").alias(f"n_{r.kind}") for k, r in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(_listed(base, names), 256).alias("base_sha256"), _listed(all_of, names).alias("spans"))


def _sql() -> str:
    """The same scan in DuckDB: every rule over every text, positions from the pieces between matches."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    each = []
    for number, r in enumerate(RULES):
        each.append(f"""select doc_id, {number} as k, {quoted(r.kind)} as kind, i,
            list_sum(list_transform(gaps[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[:i - 1], lambda x: length(x))), 0) as s,
            length(hits[i]) as n, length(parts[i]) as g
          from (select doc_id, gaps, hits, parts, unnest(range(1, len(hits) + 1)) as i from (
            select doc_id, string_split_regex(t, {quoted(r.pattern)}) as gaps, regexp_extract_all(t, {quoted(r.pattern)}) as hits,
              regexp_extract_all(t, {quoted(r.pattern)}, {r.group}) as parts from docs) where len(hits) > 0) where length(parts[i]) >= {r.least}""")
    text = "kind || ':' || s::bigint || ':' || (s + n)::bigint"
    base = f"k < {len(BASE)}"
    counts = ", ".join(f"count(k) filter (k = {k}) as n_{r.kind}" for k, r in enumerate(BASE))
    return f"""with docs as (select doc_id, coalesce(text, '') as t from documents), found as ({' union all '.join(each)})
        select d.doc_id, {counts},
          sha256(coalesce(string_agg({text}, ',' order by s, k) filter ({base}), '')) as base_sha256,
          coalesce(string_agg({text}, ',' order by s, k), '') as spans
        from docs d left join found f on f.doc_id = d.doc_id group by d.doc_id"""


SQL = _sql()
