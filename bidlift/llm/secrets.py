"""Secret scans over a trigram inverted index.

Each rule is a regular expression. From its parse tree a Boolean query over
trigrams is derived: an OR of clauses, each an AND of trigrams that any match
must hold (letters in lower case, which widens the query and never loses a
match). The index holds postings (trigram, text key) for the trigrams that
queries name. Clauses intersect the postings; the texts left are verified with
the expression itself. A rule with a clause of no trigram scans every text.

Spans are leftmost matches that do not overlap, per rule; a rule may ask for a
minimum length of the whole match or of its second group, and matches below are
dropped. Positions count code points from 0, ends are exclusive. They come from
splitting the text at its matches, so all of it runs inside the JVM.

Defined results: a NULL text is empty and has no span. Repeated rows each give
a row; the index keys on (id, text), so a hash collision only verifies one text
more. NULL ids are kept. Only ``id`` and ``text`` are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, unwrapped, whole_text, wrapped

try:  # the parser of Python's regular expressions
    from re import _constants as sre, _parser as sre_parse
except ImportError:  # before 3.11
    import sre_constants as sre, sre_parse


@dataclass(frozen=True)
class Rule:
    """``least`` characters in the whole match, or in group 2 if ``group2``."""

    name: str
    pattern: str
    least: int = 0
    group2: bool = False


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The three base kinds in the order that breaks ties.
BASE = (
    Rule(
        "assign",
        "(" + "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key"))) + ")"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        6,
        True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}"),  # the runs of 24 or more; shorter runs are no matches
)
# Published token formats.
EXTRA = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
)
RULES = BASE + EXTRA
MOST_CLAUSES = 64
BREAK = "\0"


def _alternatives(tree) -> list[str]:
    """Texts that stand for all matches of the tree; BREAK is an unknown stretch."""
    out = [""]
    for op, arg in tree:
        if op is sre.LITERAL:
            new = [chr(arg).lower()]
        elif op is sre.IN:
            members = {chr(a).lower() if o is sre.LITERAL else BREAK for o, a in arg}
            new = sorted(members) if BREAK not in members and len(members) <= 8 else [BREAK]
        elif op is sre.SUBPATTERN:
            new = _alternatives(arg[-1])
        elif op is sre.BRANCH:
            new = sorted({a for branch in arg[1] for a in _alternatives(branch)})
        elif op is sre.MAX_REPEAT:
            low, high, body = arg
            once = _alternatives(body)
            if (low, high) == (0, 1):
                new = ["", *once]
            elif low == high and low <= 8 and len(once) == 1:
                new = [once[0] * low]
            else:
                new = [BREAK] if low == 0 else [a + BREAK for a in once]
        else:
            new = [BREAK]
        joined = sorted({a + b for a in out for b in new})
        # Too many: this part is taken as unknown, which only widens the query.
        out = joined if len(joined) <= MOST_CLAUSES else [a + BREAK for a in out]
    return out


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """OR of ANDs of trigrams that every match holds; [] if some match need hold none."""
    clauses = set()
    for text in _alternatives(sre_parse.parse(pattern)):
        clauses.add(frozenset(run[i : i + 3] for run in text.split(BREAK) for i in range(len(run) - 2)))
    least = [c for c in clauses if not any(o < c for o in clauses)]
    return [] if frozenset() in least else sorted(least, key=sorted)


def build_index(texts: DataFrame, trigrams: list[str], key: str = "key", text: str = "text") -> DataFrame:
    """Postings (trigram, key), one for each text that holds the trigram in any case."""
    low = texts.select(key, F.lower(text).alias("low"))
    found = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return low.select(key, F.explode(found).alias("trigram"))


def candidates(postings: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(key, rules): bit r is set where the postings satisfy the query of rule r."""
    spark = postings.sparkSession
    wanted = []  # bounded by the rules
    for r, rule in enumerate(rules):
        for c, clause in enumerate(trigram_query(rule.pattern)):
            wanted += [(t, r, c, 1 << i, (1 << len(clause)) - 1) for i, t in enumerate(sorted(clause))]
    query = spark.createDataFrame(wanted, "trigram string, rule int, clause int, bit long, whole long")
    met = postings.join(F.broadcast(query), "trigram").groupBy("key", "rule", "clause").agg(
        F.bit_or("bit").alias("bits"), F.first("whole").alias("whole")
    )
    bit = F.expr("shiftleft(1L, rule)")
    return met.where("bits = whole").groupBy("key").agg(F.bit_or(bit).alias("rules"))


def spans_of(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, kind order, end, kind) of the rule's matches."""
    pattern = F.lit(rule.pattern)
    cuts = F.transform(F.split(text, rule.pattern), lambda p: F.char_length(p))
    lengths = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda m: F.char_length(m))
    measured = F.transform(F.regexp_extract_all(text, pattern, F.lit(2)), lambda m: F.char_length(m)) if rule.group2 else lengths
    nothing = F.array().cast("array<struct<start:int,kind_order:int,end:int,kind:string>>")
    start = F.struct(F.lit(0).alias("at"), nothing.alias("out"))

    def step(acc, m):
        begin = acc["at"] + m["cut"]
        end = begin + m["length"]
        span = F.struct(begin.alias("start"), F.lit(order).alias("kind_order"), end.alias("end"), F.lit(rule.name).alias("kind"))
        return F.struct(
            end.alias("at"),
            F.when(m["measured"] >= rule.least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"),
        )

    matches = F.transform(
        lengths, lambda n, i: F.struct(F.get(cuts, i).alias("cut"), n.alias("length"), F.get(measured, i).alias("measured"))
    )
    return F.when(F.rlike(text, pattern), F.aggregate(matches, start, step, lambda acc: acc["out"])).otherwise(nothing)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row: all columns of ``docs``, whole: its text, spans_by_rule: for each rule its array of spans)."""
    keyed = wrapped(docs, key=F.xxhash64(F.col(id), whole_text(text)), whole=whole_text(text))
    queries = [trigram_query(r.pattern) for r in rules]
    trigrams = sorted({t for q in queries for c in q for t in c})
    texts = docs.select(F.xxhash64(F.col(id), whole_text(text)).alias("key"), whole_text(text).alias("text"))
    postings = materialize(build_index(texts, trigrams), "postings")
    found = materialize(candidates(postings, rules), "candidates")
    rows = keyed.join(found, "key", "left")
    bits = F.coalesce("rules", F.lit(0))
    by_rule = []
    for r, (rule, query) in enumerate(zip(rules, queries)):
        spans = spans_of(F.col("whole"), rule, r)
        if query:
            none = F.array().cast("array<struct<start:int,kind_order:int,end:int,kind:string>>")
            spans = F.when(bits.bitwiseAND(1 << r) != 0, spans).otherwise(none)
        by_rule.append(spans)
    return rows.select("row", "whole", F.array(*by_rule).alias("spans_by_rule"))


def told(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, joined by commas."""
    return F.array_join(
        F.transform(
            F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def scan_secrets(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document row: counts of the base kinds, the digest of their spans, and all spans."""
    found = find_secrets(docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")), RULES)
    found = found.select("row.doc_id", "spans_by_rule")
    base = F.flatten(F.slice("spans_by_rule", 1, len(BASE)))
    counts = [F.size(F.col("spans_by_rule")[i]).cast("bigint").alias(f"n_{r.name}") for i, r in enumerate(BASE)]
    return found.select(
        "doc_id", *counts, F.sha2(told(base), 256).alias("base_sha256"), told(F.flatten("spans_by_rule")).alias("spans")
    )


def redact(docs: DataFrame, mark: str = "[SECRET]", id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by ``mark``; overlapping spans by one mark. Texts without a span stay as they are."""
    found = find_secrets(docs, RULES, id, text).withColumn("spans", F.array_sort(F.flatten("spans_by_rule")))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        gap = F.substring(F.col("whole"), acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"),
        )

    def rest(acc):
        return F.concat(acc["out"], F.substring(F.col("whole"), acc["at"] + 1, F.char_length("whole")))

    cleaned = F.when(F.size("spans") > 0, F.aggregate("spans", start, step, rest)).otherwise(F.col("row")[text])
    return unwrapped(found, docs.columns, **{text: cleaned})


__all__ = ["Rule", "RULES", "BASE", "EXTRA", "trigram_query", "build_index", "candidates", "find_secrets", "scan_secrets", "redact"]
