"""Personal data by bootstrapped contextual extraction, in DataFrame operations only.

Base patterns find seed entities. The words around them are lexical patterns; patterns and the identifiers they enclose
form a graph, scored in turns: a pattern by the share of its identifiers that are known, an identifier by its best
trusted pattern. Identifiers in trusted contexts that no base pattern knows are added.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwright.llm.shared import materialize, skew_safe_lookup

#: The kinds, in order of rank, with what a match looks like. Possessive forms of the plain patterns: none of them can
#: gain by giving characters back, and so none backtracks or recurses on long runs. Cards begin with the 14 digits the
#: shortest has: shorter runs fail anyway.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be worth trying.
HINTS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]"}
#: Words with a digit or an at sign, and runs of them with single spaces between: what may be an identifier.
SHAPED = r"(?:\G|(?<=[\x20\x09-\x0D]))[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+(?:\x20[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+)*+"
OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|(?<=0))"
#: Matches laid end to end at a time.
BLOCK = 256
#: Characters of a strip; texts are cut into strips so that what stands around a span is found without a walk from the start.
STRIP = 512
#: Characters on either side of a span within which the words of its context lie whole; else it has none.
REACH = 128
#: Longer runs of shaped words are no identifier, but their words may be.
LONGEST = 64


def digits(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def luhn(number: Column) -> Column:
    back = F.reverse(number)
    value = lambda i: F.substring(back, i, F.lit(1)).cast("int")
    term = lambda i: F.when(i % 2 == 1, value(i)).when(value(i) > 4, value(i) * 2 - 9).otherwise(value(i) * 2)
    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), lambda a, i: a + term(i)) % 10 == 0


def holds(kind: str, match: Column) -> Column:
    """Whether a match of a kind's pattern passes its checks."""
    number = digits(match)
    if kind == "ip":
        return match.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(number).between(14, 19), luhn(number)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(number).between(10, 15)
    return F.lit(True)


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value computed once."""
    return F.transform(F.array(value), then)[0]


def in_blocks(items: Column) -> Column:
    """A non-empty array's elements in arrays of BLOCK."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int")), lambda b: F.slice(items, b * BLOCK + 1, F.lit(BLOCK)))


def located(text: Column, pattern: str, hint: str) -> Column:
    """array<struct<start, end, match>> of the leftmost, non-overlapping matches; code points, end exclusive.

    Each match is taken with the gap before it, anchored where the last one ended; their lengths add up to positions.
    """
    gapped = F.lit(rf"\G((?s:.*?))({pattern})")
    pairs = F.arrays_zip(F.regexp_extract_all(text, gapped, F.lit(1)).alias("gap"), F.regexp_extract_all(text, gapped, F.lit(2)).alias("match"))
    pairs = F.transform(pairs, lambda p: F.struct(F.length(p["gap"]).alias("gap"), p["match"].alias("match")))
    kind = "array<struct<start:int,end:int,match:string>>"

    def lay(block: Column, base: Column) -> Column:
        start = F.struct(base.alias("at"), F.array().cast(kind).alias("out"))
        step = lambda a, p: F.struct(
            (a["at"] + p["gap"] + F.length(p["match"])).alias("at"),
            F.concat(a["out"], F.array(F.struct((a["at"] + p["gap"]).alias("start"), (a["at"] + p["gap"] + F.length(p["match"])).alias("end"), p["match"].alias("match")))).alias("out"),
        )
        return F.aggregate(block, start, step, lambda a: a["out"])

    def whole(pairs: Column) -> Column:
        blocks = in_blocks(pairs)
        long = lambda block: F.aggregate(block, F.lit(0), lambda n, p: n + p["gap"] + F.length(p["match"]))
        bases = F.aggregate(blocks, F.array(F.lit(0)), lambda a, b: F.concat(a, F.array(F.element_at(a, -1) + long(b))))
        return F.flatten(F.zip_with(blocks, F.slice(bases, F.lit(1), F.size(blocks)), lay))

    none = F.array().cast(kind)
    some = let(pairs, lambda p: F.when(F.size(p) > 0, whole(p)).otherwise(none))  # the matches are found once
    return F.when(text.rlike(hint), some).otherwise(none)


def context(strips: Column, start: Column, end: Column) -> tuple[Column, Column]:
    """The two words before a span (^ stands for one before the text) and the one after it, folded in case, their digits
    made 0; empty if they don't lie whole within REACH."""
    fold = lambda c: F.regexp_replace(F.lower(c), r"[0-9]", "0")
    strip = lambda k: F.coalesce(F.get(strips, k), F.lit(""))
    at = lambda p: F.floor(p / STRIP).cast("int")
    before = F.concat(F.when(at(start) < 1, F.lit(" ^ ")).otherwise(strip(at(start) - 1)), F.substring(strip(at(start)), F.lit(1), start % STRIP))
    after = F.concat(F.substring(strip(at(end)), end % STRIP + 1, F.lit(STRIP)), strip(at(end) + 1), F.when(at(end) + 2 >= F.size(strips), F.lit(" ")).otherwise(F.lit("")))
    left = F.regexp_extract(F.right(before, F.lit(REACH)), r"[\x20\x09-\x0D]([^\x20\x09-\x0D]++[\x20\x09-\x0D]++[^\x20\x09-\x0D]++)[\x20\x09-\x0D]*+$", 1)
    right = F.regexp_extract(F.left(after, F.lit(REACH)), r"^[^\x20\x09-\x0D]*+[\x20\x09-\x0D]++([^\x20\x09-\x0D]++)[\x20\x09-\x0D]", 1)
    return fold(F.regexp_replace(left, r"[\x20\x09-\x0D]++", " ")), fold(right)


def apart(shaped: Column, seeds: Column) -> Column:
    """The shaped runs that touch no seed; of runs that do, and of long ones, the words that touch none.

    Both arrays are in order; each block of runs looks only at the blocks of seeds that reach into it.
    """

    def free(block: Column, near: Column) -> Column:
        clash = lambda s: F.exists(near, lambda b: (b["start"] < s["end"]) & (b["end"] > s["start"]))
        moved = lambda s: F.transform(located(s["match"], r"[^\x20]++", "."), lambda w: F.struct((s["start"] + w["start"]).alias("start"), (s["start"] + w["end"]).alias("end"), w["match"].alias("match")))
        pieces = lambda s: F.filter(moved(s), lambda w: w["match"].rlike("[0-9@]") & ~clash(w))
        return F.flatten(F.transform(block, lambda s: F.when(clash(s) | (F.length(s["match"]) > LONGEST), pieces(s)).otherwise(F.array(s))))

    def whole(bounded: Column) -> Column:
        reach = lambda block: F.flatten(F.transform(F.filter(bounded, lambda q: (q["high"] > block[0]["start"]) & (q["low"] < F.element_at(block, -1)["end"])), lambda q: q["part"]))
        return F.flatten(F.transform(in_blocks(shaped), lambda block: let(reach(block), lambda near: free(block, near))))

    ends = lambda part: F.struct(part[0]["start"].alias("low"), F.array_max(F.transform(part, lambda b: b["end"])).alias("high"), part.alias("part"))
    bounded = F.when(F.size(seeds) > 0, F.transform(in_blocks(seeds), ends)).otherwise(F.array())
    return F.when(F.size(shaped) > 0, let(bounded, whole)).otherwise(shaped)


def entities(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """uid, doc_id and two arrays of spans with their contexts: base (checked matches) and rest (other shaped words)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))

    def checked(n: int, kind: str) -> Column:
        right = F.filter(located(F.col("text"), PATTERNS[kind], HINTS[kind]), lambda m: holds(kind, m["match"]))
        return F.transform(right, lambda m: F.struct(m["start"], F.lit(n).alias("kind"), m["end"], m["match"]))

    found = [checked(n, k) for n, k in enumerate(KINDS)]
    rows = rows.select("*", F.array_sort(F.flatten(F.array(*found))).alias("seeds"), located(F.col("text"), SHAPED, r"[0-9@]").alias("shaped"))

    def dressed(spans: Column, kind) -> Column:
        def dress(s: Column) -> Column:
            left, right = context(F.col("strips"), s["start"], s["end"])
            return F.struct(s["start"], kind(s).alias("kind"), s["end"], F.lower(s["match"]).alias("what"), left.alias("left"), right.alias("right"))

        return F.transform(spans, dress)

    rows = rows.withColumn("strips", F.when(F.size("seeds") + F.size("shaped") > 0, F.regexp_extract_all("text", F.lit(rf"(?s).{{1,{STRIP}}}"), F.lit(0))))
    return rows.select("uid", "doc_id", dressed(F.col("seeds"), lambda s: s["kind"]).alias("base"), dressed(apart(F.col("shaped"), F.col("seeds")), lambda s: F.lit(None).cast("int")).alias("rest"))


def learned(found: DataFrame, *, rounds: int, trust: float, support: float, doubt: float) -> DataFrame | None:
    """(pattern, rows, trust: for each kind, null if it isn't trusted for it) of the trusted patterns after `rounds` turns
    over the pattern-instance graph, None if there are none; rows is the number of spans a pattern stands around.

    Every join is to a table of unique keys that knows how many rows each meets, so that no frequent pattern or
    identifier fills a task.
    """
    each, score, none = range(len(KINDS)), lambda k: F.col(f"s{k}"), F.lit(None).cast("double")
    units = found.select(F.explode(F.concat("base", "rest")).alias("s")).select("s.kind", "s.what", *patterns("s"))
    met = units.select("kind", "what", F.explode("patterns").alias("pattern")).where("pattern is not null")
    seen = [F.max(F.when(F.col("kind") == k, 1.0)).alias(f"s{k}") for k in each]
    edges = materialize(met.groupBy("pattern", "what").agg(*seen, F.count(F.lit(1)).alias("rows")), "pii-edges")
    sizes = materialize(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("rows")).where(F.col("n") >= support), "pii-sizes")
    kept = materialize(skew_safe_lookup(edges.drop("rows"), sizes, "pattern", "n"), "pii-kept")
    seeds = materialize(edges.groupBy("what").agg(*[F.max(f"s{k}").alias(f"s{k}") for k in each]).where(F.coalesce(*map(score, each)).isNotNull()), "pii-seeds")
    degrees = materialize(kept.groupBy("what").agg(F.count(F.lit(1)).alias("degree")), "pii-degrees")
    scores = seeds
    for _ in range(rounds):
        known = skew_safe_lookup(kept.select("pattern", "what"), scores.join(degrees, "what"), "what", "degree")
        known = known.groupBy("pattern").agg(F.count(F.lit(1)).alias("known"), *[F.sum(score(k)).alias(f"s{k}") for k in each])
        against = F.col("known") + doubt * (F.col("n") - F.col("known")) + 1
        rated = known.join(sizes, "pattern").select("pattern", "n", "rows", *[F.when((score(k) / against >= trust) & (score(k) >= support), score(k) / against).alias(f"s{k}") for k in each])
        trusted = materialize(rated.where(F.coalesce(*map(score, each)).isNotNull()), "pii-trusted")
        if not trusted.head(1):  # nothing new is known, so further turns would find the same
            return None
        reached = skew_safe_lookup(kept.select("pattern", "what"), trusted, "pattern", "n").groupBy("what").agg(*[F.max(score(k)).alias(f"s{k}") for k in each])
        scores = seeds.unionByName(reached.join(seeds.select("what"), "what", "left_anti"))
    return trusted.select("pattern", "rows", *[F.coalesce(score(k), none).alias(f"s{k}") for k in each])


def patterns(span: str) -> list[Column]:
    """The lexical patterns around a span: the two words before it; the word before and the word after."""
    left, right = F.col(f"{span}.left"), F.col(f"{span}.right")
    pair = F.when((left != "") & (right != ""), F.concat(F.lit("around "), F.element_at(F.split(left, " "), -1), F.lit(" _ "), right))
    return [F.array(F.when(left != "", F.concat(F.lit("after "), left)), pair).alias("patterns")]


def spelled(spans: Column) -> Column:
    name = lambda n: reduce(lambda c, k: c.when(n == k, F.lit(KINDS[k])), range(1, len(KINDS)), F.when(n == 0, F.lit(KINDS[0])))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3, trust: float = 0.8, support: float = 4.0, doubt: float = 0.5) -> DataFrame:
    """One row per input row: doc_id, base and spans (arrays of start, kind, end by start, then kind's rank in KINDS).

    base: the matches of the kinds' patterns that pass their checks. spans: these and the spans learned: words with a
    digit or an at sign, and runs of them, apart from base spans, in a context that is trusted for the kind: of the
    different identifiers it encloses, at least `support` are known to be of the kind, and these make up at least
    `trust` of all, where one not known at all counts as `doubt` of one, and one more counts against. Of several trusted
    contexts or kinds the most trusted decides (ties: the first kind). A context is the two words before a span, or the
    one before and the one after it. Null is the empty text and has no spans; rows that repeat a doc_id are rows of
    their own; an empty table gives an empty result; other columns are not looked at.
    """
    found = materialize(entities(docs, id_col, text_col), "pii-entities")
    trusted = learned(found, rounds=rounds, trust=trust, support=support, doubt=doubt)
    plain = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    if trusted is None:
        return found.select("doc_id", plain.alias("base"), plain.alias("spans"))
    rest = found.select("uid", F.explode("rest").alias("s")).select("uid", "s.start", "s.end", *patterns("s"))
    met = skew_safe_lookup(rest.select("uid", "start", "end", F.explode("patterns").alias("pattern")).where("pattern is not null"), trusted, "pattern", "rows")
    best = met.groupBy("uid", "start", "end").agg(F.greatest(*[F.max(F.struct(F.coalesce(F.col(f"s{k}"), F.lit(-1.0)).alias("trust"), F.lit(-k).alias("rank"))) for k in range(len(KINDS))]).alias("best"))
    added = best.groupBy("uid").agg(F.collect_list(F.struct("start", (-F.col("best.rank")).alias("kind"), "end")).alias("added"))
    whole = found.select("uid", "doc_id", plain.alias("base")).join(added, "uid", "left")
    return whole.select("doc_id", "base", F.array_sort(F.concat("base", F.coalesce("added", F.array().cast("array<struct<start:int,kind:int,end:int>>")))).alias("spans"))


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans."""
    found = find_personal_data(docs, **options)
    count = lambda n: F.size(F.filter("base", lambda s: s["kind"] == n)).cast("long")
    counts = [count(n).alias(f"n_{k}") for n, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(spelled(F.col("base")), 256).alias("base_sha256"), spelled(F.col("spans")).alias("spans"))
