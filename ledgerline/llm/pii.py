"""Personal data by bootstrapped contextual extraction, with DataFrame functions only.

Regular expressions find entities of four kinds; they are the seeds. The words around an
occurrence are lexical patterns (the word before, the word after, both). Patterns and the
texts of entities and of other identifier-like tokens form a weighted graph, on which
scores go back and forth: a pattern's confidence is the share of its occurrences whose
texts are known to be of a kind; a text's score comes from the confident patterns it
stands in. After a few rounds, tokens in confident patterns are spans too.

The texts are scanned once. Spans and contexts, a small fraction of the texts, are stored;
scoring works on counts per pattern and text, so a common word is only a large count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.lineage import cut, stage

KINDS = ("email", "ip", "card", "phone")
# Patterns match what the documented ones match. Possessive repeats and the look-behinds
# only spare the search places where no match can begin, and deep recursion on long runs.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Identifier-like tokens: at least four digits, or an at sign.
TOKEN = r"(?<!\S)(?=[^\s@]*+@|(?:[^\s0-9]*+[0-9]){4})\S++"
_PUNCTUATION = ".,;:!?\"'()[]<>"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_NEAR = 40  # characters looked at for a context word
CONFIDENCE = 0.75
SEEDS = 3  # distinct known texts a pattern needs
ROUNDS = 3


def _spans(text: Column, pattern: str) -> Column:
    """Matches in order as ``start, end`` (code points) and ``found``."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    steps = F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("found")))
    empty = F.expr("cast(array() as array<struct<start:int,end:int,found:string>>)")

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["found"])
        one = F.struct(start.alias("start"), end.alias("end"), x["found"].alias("found"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    walk = F.aggregate(steps, F.struct(F.lit(0).alias("at"), empty.alias("out")), add, lambda acc: acc["out"])
    return F.when(text.rlike(pattern), walk).otherwise(empty)


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check sum."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: d.try_cast("int"))

    def share(d: Column, i: Column) -> Column:
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.transform(values, share), F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0)))
    return total % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    n = F.length(_digits(found))
    if kind == "ip":
        return found.rlike(rf"^(?:{_PART}\.){{3}}{_PART}$")
    if kind == "card":
        return F.when(n.between(14, 19), _luhn(_digits(found))).otherwise(F.lit(False))
    return n.between(10, 15) if kind == "phone" else F.lit(True)


def find_base(docs: DataFrame) -> DataFrame:
    """``doc_id, key, base, near``: the regular expressions' spans, and for these and other
    identifier-like tokens their text and the words around. ``key`` tells rows apart whose
    ids or texts differ. ``docs`` has ``doc_id`` and ``text`` without nulls."""
    text = F.col("text")

    def valid(kind: str) -> Column:
        return F.filter(_spans(text, PATTERNS[kind]), lambda s: _valid(kind, s["found"])).alias(kind)

    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text", *map(valid, KINDS), _spans(text, TOKEN).alias("token"))

    def kinded(kind: str, rank: int) -> Column:
        return F.transform(kind, lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("kind"), s["end"].alias("end"), s["found"].alias("found")))

    def trimmed(s: Column) -> Column:
        lead = F.length(s["found"]) - F.length(F.ltrim(s["found"], F.lit(_PUNCTUATION)))
        found = F.btrim(s["found"], F.lit(_PUNCTUATION))
        start = s["start"] + lead
        return F.struct(start.alias("start"), F.lit(-1).alias("kind"), (start + F.length(found)).alias("end"), found.alias("found"))

    base = F.array_sort(F.concat(*[kinded(k, i) for i, k in enumerate(KINDS)]))
    rows = rows.withColumn("base", base)
    free = F.filter(F.transform("token", trimmed), lambda t: (F.length(t["found"]) > 0) & ~F.exists(
        "base", lambda b: (b["start"] < t["end"]) & (b["end"] > t["start"])))
    rows = rows.withColumn("near", F.concat("base", free))

    def around(s: Column) -> Column:
        first = F.greatest(s["start"] - _NEAR, F.lit(0))
        before = F.substring(text, first + 1, s["start"] - first)
        after = F.substring(text, s["end"] + 1, F.lit(_NEAR))
        return F.struct(
            *[s[c].alias(c) for c in ("start", "kind", "end", "found")],
            F.lower(F.regexp_extract(before, r"(\S+)\s*$", 1)).alias("left"),
            F.lower(F.regexp_extract(after, r"^\S{0,3}\s+(\S+)", 1)).alias("right"),
        )

    return rows.select("doc_id", "key", "base", F.transform("near", around).alias("near"))


def patterns(occurrences: DataFrame) -> DataFrame:
    """One row per occurrence and lexical pattern it stands in."""
    left, right = F.col("left"), F.col("right")
    both = F.array(F.concat(F.lit("L:"), left), F.concat(F.lit("R:"), right), F.concat(F.lit("B:"), left, F.lit(" "), right))
    both = F.when((left != "") & (right != ""), both).when(left != "", F.slice(both, 1, 1)).when(right != "", F.slice(both, 2, 1))
    return occurrences.withColumn("pattern", F.explode(both))


def _shaped(kind: Column, found: Column) -> Column:
    """Whether a token could be of the kind at all."""
    digits = F.length(_digits(found))
    numeric = found.rlike("^[-+().0-9/ ]+$")
    return F.when(kind == 0, found.contains("@")).when(kind == 1, numeric & found.contains(".")).otherwise(numeric & (digits >= 7))


def bootstrap(occurrences: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE, seeds: int = SEEDS) -> tuple[DataFrame, DataFrame]:
    """Confident patterns (``pattern, kind, conf``) and scored texts (``found, kind, score``)."""
    graph = cut(patterns(occurrences).groupBy("pattern", "found", "kind").agg(F.count("*").alias("n")))
    known = cut(graph.where("kind >= 0").select("found", "kind").distinct().withColumn("score", F.lit(1.0)))
    total = graph.groupBy("pattern").agg(F.sum("n").alias("total"))
    texts = graph.groupBy("pattern", "found").agg(F.sum("n").alias("n"))
    open_texts = graph.where("kind < 0").select("pattern", "found").distinct()
    scores, confident = known, None
    for _ in range(rounds):
        seen = texts.join(scores, "found").groupBy("pattern", "kind").agg(
            F.sum(F.col("n") * F.col("score")).alias("good"), F.sum((F.col("score") == 1.0).cast("int")).alias("seeds"))
        confident = seen.where(F.col("seeds") >= seeds).join(total, "pattern").withColumn("conf", F.col("good") / (F.col("total") + 1.0))
        confident = cut(confident.where(F.col("conf") >= confidence).select("pattern", "kind", "conf"))
        miss = F.exp(F.sum(F.log(1.0 - F.least("conf", F.lit(0.999)))))
        new = open_texts.join(confident, "pattern").where(_shaped(F.col("kind"), F.col("found")))
        new = new.groupBy("found", "kind").agg((1.0 - miss).alias("score")).where(F.col("score") >= confidence)
        new = new.join(known.select("found", "kind"), ["found", "kind"], "left_anti")
        scores = cut(known.union(new.select("found", "kind", "score")))
    return confident, scores


def find(docs: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE, seeds: int = SEEDS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``base`` and ``added``, arrays of
    ``start, kind, end`` in that order (code points, end exclusive; kinds count in ``KINDS``).

    A null text is empty. Added spans overlap no base span; one token gets the kind with
    the best score, ties to the kind first in ``KINDS``. Equal rows get equal results; a
    null id stays null. Columns besides ``doc_id`` and ``text`` are not read.
    """
    clean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    stored = stage(find_base(clean), "pii")
    # equal rows hold equal spans: they count once and share the result
    distinct = stored.where(F.size("near") > 0).dropDuplicates(["key"])
    occurrences = distinct.select("key", F.inline("near"))
    confident, scores = bootstrap(occurrences, rounds, confidence, seeds)
    free = patterns(occurrences.where("kind < 0").drop("kind"))
    hit = free.join(confident, "pattern").join(scores, ["found", "kind"])
    best = F.max_by("kind", F.struct("score", (-F.col("kind")).alias("first"))).alias("kind")
    spans = hit.groupBy("key", "start", "end").agg(best)
    added = spans.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("added"))
    slim = F.transform("base", lambda s: F.struct(*[s[c].alias(c) for c in ("start", "kind", "end")]))
    none = F.expr("cast(array() as array<struct<start:int,kind:int,end:int>>)")
    return stored.join(added, "key", "left").select("doc_id", slim.alias("base"), F.coalesce("added", none).alias("added"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets. Of overlapping spans the
    first by start, kind, end is replaced; later ones begin after it."""
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        new = F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, F.get(names, s["kind"])).alias("out"))
        return F.when(s["start"] >= acc["at"], new).otherwise(acc)

    return F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
