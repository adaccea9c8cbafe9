"""Secret scans: rules for known forms, and character Markov models for random strings of any form.

Two first-order models, of random strings and of ordinary identifiers, give each string of at least 16 characters a
log-likelihood ratio; a string that is likelier random by a margin is a finding. All that touches texts is SQL functions on
columns. The models are two small tables of counts, which become one array in the plan.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds of findings by rule, in order: the pattern, which group must be how long.
RULES: dict[str, tuple[str, int, int]] = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
# Runs of one class of characters are as long as they get, so that for these a minimal length finds the same matches.
FASTER = {"access": r"AKIA[A-Z0-9]{16,}+", "hex": r"[0-9a-f]{24,}+"}

#: The kind of what the models find, and the characters and least length of the strings they judge.
RANDOM = "random"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+"
STATES = len(ALPHABET) + 1  # state 0 is before the first character
#: Log-likelihood ratio (natural logarithm) from which a string is a finding: about one in 20,000 by chance.
LIMIT = 10.0
BLOCK = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sums_before(sizes: Column) -> Column:
    """For each element of an array of integers (not empty), the sum of those before it; by blocks, so that long arrays stay cheap."""
    add = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)

    def within(a: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / BLOCK).cast("int")), lambda b: add(F.slice(a, b * BLOCK + 1, F.lit(BLOCK))))
        heads = lambda s: F.transform(s, lambda x, b: add(F.slice(s, F.lit(1), b)))
        each = lambda h: F.transform(a, lambda x, i: F.get(h, F.floor(i / BLOCK).cast("int")) + add(F.slice(a, (i - i % BLOCK) + 1, i % BLOCK)))
        return let(blocks, lambda s: let(heads(s), each))

    return let(sizes, within)


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches, leftmost first without overlap: structs ``start, end`` (code points, end exclusive), ``value`` (the group)."""
    whole, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else None

    def sized(w: Column) -> Column:
        return F.zip_with(F.slice(gaps, F.lit(1), F.size(w)), w, lambda g, x: F.struct(F.char_length(g).alias("gap"), F.char_length(x).alias("size"), x.alias("value")))

    def placed(z: Column) -> Column:
        before = sums_before(F.transform(z, lambda x: x["gap"] + x["size"]))
        return F.zip_with(z, before, lambda x, b: F.struct((b + x["gap"]).alias("start"), (b + x["gap"] + x["size"]).alias("end"), x["value"].alias("value")))

    found = let(let(whole, sized), placed)
    if value is not None:
        found = F.zip_with(found, value, lambda x, v: F.struct(x["start"].alias("start"), x["end"].alias("end"), v.alias("value")))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(text.rlike(pattern), found).otherwise(none)


def rule_matches(text: Column, kind: str) -> Column:
    """Matches of a rule whose group is long enough."""
    pattern, group, least = RULES[kind]
    if kind in FASTER:
        return matches(text, FASTER[kind])
    return F.filter(matches(text, pattern, group), lambda m: F.char_length(m["value"]) >= least)


def _codes(string: Column) -> Column:
    """The states of a string's characters: 1 and up; 0 for a character that is not in the alphabet."""
    places = F.sequence(F.lit(1), F.char_length(string))
    return F.transform(places, lambda i: F.call_function("instr", F.lit(ALPHABET), F.substring(string, i, F.lit(1))))


def markov_table(samples: DataFrame, smooth: float = 0.5) -> list[float]:
    """Log-likelihood ratios of the steps from state to state: random against ordinary, row by row.

    ``samples`` has ``text`` and ``random`` (boolean), strings in :data:`ALPHABET`; other characters are left out, as are
    null and empty ones. Counts are over all samples; ``smooth`` is added to each. Without samples all ratios are 0.
    """
    # each character with the one before it; 0 stands before the first
    known = samples.where("random is not null and text <> ''").select("random", F.regexp_replace("text", f"[^{ALPHABET[:-1]}\\-]", "").alias("s")).where("s <> ''")
    step = let(_codes(F.col("s")), lambda c: F.transform(c, lambda x, i: F.when(i == 0, x).otherwise(F.get(c, i - 1) * STATES + x)))
    counted = known.select("random", F.explode(step).alias("step")).groupBy("random", "step").agg(F.count("*").alias("n"))
    counts = {(r.random, *divmod(r.step, STATES)): r.n for r in counted.collect()}  # STATES^2 rows at most, twice
    share: dict[bool, list[float]] = {}
    for kind in (False, True):
        share[kind] = []
        for a in range(STATES):
            row = [counts.get((kind, a, b), 0) + smooth for b in range(1, STATES)]
            share[kind] += [0.0, *[math.log(n / sum(row)) for n in row]]
    return [round(r - o, 6) for r, o in zip(share[True], share[False])]


def random_ratio(string: Column, table: list[float]) -> Column:
    """The log-likelihood ratio of a string in :data:`ALPHABET`: the sum over its steps."""
    ratios = F.from_json(F.lit(json.dumps(table)), "array<double>")
    step = lambda acc, x: F.struct((acc["s"] + F.get(ratios, acc["a"] * STATES + x)).alias("s"), x.alias("a"))
    return F.aggregate(_codes(string), F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("a")), step, lambda acc: acc["s"])


def labelled_samples(docs: DataFrame, text: str = "text") -> DataFrame:
    """``text, random``: different strings of all documents with their label.

    Random: what the rules find, and hashes of each text as base 64, in capitals and in hexadecimal digits. Ordinary: words of
    at least 10 letters, and identifiers made of two neighbouring ones of at least 12 (joined by case, ``_``, ``-`` or ``/``,
    some with a number).
    """
    body = F.coalesce(F.col(text), F.lit(""))
    values = [F.filter(F.regexp_extract_all(body, F.lit(FASTER.get(k, p)), F.lit(g)), lambda v: F.char_length(v) >= F.lit(6)) for k, (p, g, _) in RULES.items()]
    found = F.concat(*values)
    long = F.array_distinct(F.regexp_extract_all(body, F.lit("(?<![A-Za-z])[A-Za-z]{10,}+"), F.lit(0)))

    def joined(w: Column) -> Column:
        def one(a: Column, i: Column) -> Column:
            b = F.get(w, i + 1)
            way = F.pmod(F.xxhash64(a), F.lit(4))
            by = F.when(way == 0, F.concat(a, F.initcap(b))).when(way == 1, F.concat_ws("_", a, b)).when(way == 2, F.concat_ws("-", F.lower(a), F.lower(b)))
            return by.otherwise(F.concat(a, F.lit("/"), b, F.lit("_"), (i % 100).cast("string")))

        return F.transform(F.slice(w, F.lit(1), F.size(w) - 1), one)

    names = let(F.filter(long, lambda w: F.char_length(w) >= 12), lambda w: F.when(F.size(w) > 1, joined(w)).otherwise(F.array().cast("array<string>")))
    digests = [F.base64(F.unhex(F.sha2(F.concat(body, F.lit(salt)), 512))) for salt in ("", "#", "##")]
    made = let(F.array(*[F.rtrim(d, F.lit("=")) for d in digests]), lambda d: F.concat(d, F.array(F.upper(F.substring(d[0], 1, 20)), F.md5(d[0]))))
    tagged = lambda strings, random: F.transform(strings, lambda t: F.struct(t.alias("text"), F.lit(random).alias("random")))
    every = docs.select(F.inline(F.concat(tagged(long, False), tagged(names, False), tagged(found, True), tagged(made, True))))
    return every.distinct()


def scan(docs: DataFrame, table: list[float], limit: float = LIMIT, text: str = "text") -> DataFrame:
    """``docs`` with ``findings``: structs ``start, kind (its place), end, name``, in order of start, then kind.

    Findings of rules all stay; strings that the models call random are added unless they overlap one of those. Places are
    code points of the whole text, ends exclusive. A null text counts as empty; texts of any length are taken whole, and
    a column ``findings`` gives way.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    kinds = [*RULES, RANDOM]

    def named(found: Column, kind: str) -> Column:
        return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(kinds.index(kind)).alias("kind"), m["end"].alias("end"), F.lit(kind).alias("name")))

    ruled = F.flatten(F.array(*[named(rule_matches(body, k), k) for k in RULES]))
    likely = F.filter(matches(body, CANDIDATE), lambda m: random_ratio(m["value"], table) >= limit)
    # a step of its own: the findings are worked out once
    both = docs.withColumn("findings", F.struct(ruled.alias("ruled"), likely.alias("likely")))

    def joined(f: Column) -> Column:
        free = F.filter(f["likely"], lambda m: ~F.exists(f["ruled"], lambda r: (r["start"] < m["end"]) & (m["start"] < r["end"])))
        return F.array_sort(F.concat(f["ruled"], named(free, RANDOM)))

    return both.withColumn("findings", let(F.col("findings"), joined))


def span_list(findings: Column) -> Column:
    """``kind:start:end`` of each finding, joined by commas."""
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["name"], f["start"].cast("string"), f["end"].cast("string"))), ",")


def secret_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of every document, repeated rows and null ids too.

    The models are trained on :func:`labelled_samples` of the same documents. An empty table gives no rows.
    """
    table = markov_table(labelled_samples(docs, text))
    found = scan(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), table)
    base = F.filter("findings", lambda f: f["kind"] < len(RULES))
    count = lambda i: F.size(F.filter("findings", lambda f: f["kind"] == i)).cast("bigint")
    return found.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(RULES)], F.sha2(span_list(base), 256).alias("base_sha256"), span_list(F.col("findings")).alias("spans"))
