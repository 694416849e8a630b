"""Personal data: exact base patterns, and identifiers found through contexts that the base ones share.

Base kinds are regular expressions with checks (see ``BASE``); their spans always stay. Around them the
method is bootstrapped:

1. Candidates are identifier-like runs: a word with a digit or ``@``, and digit groups after it. Those over a base
   span are known (seeds of that kind), the others unknown. Each has two lexical patterns: the word before it, and
   the two words before it (letters, with ``:``, ``=`` or ``#`` at the end).
2. Patterns and instances are a graph. In each round a pattern's support for a kind is the sum over its distinct
   instances of that kind: known ones count 1, found ones the score of the best pattern that found them. Against it
   stand the instances known to be of another kind, and unknown ones without the kind's shape; unknown ones that could
   be of the kind count neither way, so a pattern does not lose by what there is to find. A pattern with a support of
   ``min_support`` and a share of ``min_score`` finds the unknown instances that have the kind's shape. Found ones count
   in the next round, for patterns without any seed of their own too.
3. Unknown candidates behind a high-confidence pattern of their kind become spans of that kind.

DataFrame functions only. Texts are never shuffled: only matches are, dealt out by document. Start positions
come from splitting the text by the same expression; each expression starts at the beginning of a run
only and takes runs possessively, so long texts take linear time.

Cases: a null or empty text has no spans; rows repeat as given (same doc_id and text: the same result);
a null doc_id is a document; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from surveyspark.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
TOKEN = len(KINDS)
_LOCAL = "A-Za-z0-9._%+-"
#: Same matches as the plain expressions, leftmost and not overlapping: a match can only begin at the start of a run of its
#: first class, or where the last match ended.
BASE = (
    rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
_CANDIDATE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?:[ ][(]?[0-9][0-9().-]*+)*+"
_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_WORD = r"\p{L}{1,40}[:=#]?"
KEY = ["doc_id", "hash", "size"]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: int, match: Column) -> Column:
    n = F.length(_digits(match))
    if kind == 1:
        return match.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == 2:
        return F.when(n.between(12, 19), _luhn(_digits(match))).otherwise(False)
    if kind == 3:
        return n.between(9, 15)
    return F.lit(True)


def _shape(kind: Column, value: Column) -> Column:
    """Whether an unknown identifier can be of a kind: what the base patterns ask for, without their checks."""
    n = F.length(_digits(value))
    return (
        F.when(kind == 0, value.contains("@"))
        .when(kind == 1, value.rlike(r"^[0-9]+(?:\.[0-9]+){3,}|^[0-9a-fA-F]*:[0-9a-fA-F:]*:[0-9a-fA-F]*$"))
        .when(kind == 2, n.between(12, 19) & ~value.rlike(r"[\p{L}@]"))
        .otherwise(n.between(7, 15) & ~value.rlike(r"[\p{L}@]"))
    )


def _found(kind: int, pattern: str, text: Column, possible: Column) -> Column:
    """array<struct<kind, idx, gap, len, valid, value, before>> of an expression's matches, in order."""
    token = kind == TOKEN
    # only what is needed of the text before a match leaves the row: its length, and for candidates its last words
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.struct(F.length(g).alias("gap"), (F.lower(F.right(g, F.lit(90))) if token else F.lit("")).alias("before")))
    both = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), 0).alias("m"), gaps.alias("g"))

    def one(x: Column, i: Column) -> Column:
        m = x["m"]
        last = F.regexp_extract(x["g"]["before"], rf"(?:^|\s)((?:{_WORD}\s+)?{_WORD}\s+)$", 1) if token else F.lit("")
        return F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("idx"), x["g"]["gap"].alias("gap"), F.length(m).alias("len"), _valid(kind, m).alias("valid"), (m if token else F.lit("")).alias("value"), last.alias("before"))

    none = F.array().cast("array<struct<kind:int,idx:int,gap:int,len:int,valid:boolean,value:string,before:string>>")
    return F.when(possible, F.filter(F.transform(both, one), lambda x: x["len"].isNotNull())).otherwise(none)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, hash, size, text): what stands for a row; equal rows share it."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"), F.octet_length(text).alias("size"), text.alias("text"))


def matches(given: DataFrame) -> DataFrame:
    """Every match of the base expressions and every candidate: key, kind, start, end, valid, value, before, known (kind of the base span it lies over)."""
    text = F.col("text")
    digit = text.rlike("[0-9]")
    possible = (text.contains("@"), digit, digit, text.contains("+") & digit, digit | text.contains("@"))
    every = F.concat(*[_found(k, p, text, c) for k, (p, c) in enumerate(zip((*BASE, _CANDIDATE), possible, strict=True))])
    rows = given.where(digit | text.contains("@")).select(*KEY, F.explode(every).alias("m")).select(*KEY, "m.*")
    rows = rows.repartition(*KEY).dropDuplicates([*KEY, "kind", "idx"])
    own = W.partitionBy(*KEY, "kind").orderBy("idx").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("len")).over(own)).withColumn("start", F.col("end") - F.col("len"))
    rows = rows.where("valid").drop("gap", "len", "idx", "valid")
    # a candidate without the marks around it
    left = F.length(F.regexp_extract("value", r"^[\"'<\[{]*", 0))
    right = F.length(F.regexp_extract("value", r"[\"'>\]}.,;:!?]*$", 0))
    token = F.col("kind") == TOKEN
    rows = rows.withColumns({
        "start": F.when(token, F.col("start") + left).otherwise(F.col("start")),
        "end": F.when(token, F.col("end") - right).otherwise(F.col("end")),
        "value": F.when(token, F.regexp_replace("value", r"^[\"'<\[{]*|[\"'>\]}.,;:!?]*$", "")).otherwise(""),
    })
    base = F.when(~token, F.struct("end", "kind"))
    ahead = W.partitionBy(*KEY).orderBy("start", F.desc("kind")).rowsBetween(W.unboundedPreceding, W.currentRow)
    behind = W.partitionBy(*KEY).orderBy(F.desc("start"), "kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    over = rows.withColumns({"cover": F.max(base).over(ahead), "next": F.last(F.when(~token, F.struct("start", "kind")), ignorenulls=True).over(behind)})
    known = F.when(F.col("cover.end") > F.col("start"), F.col("cover.kind")).when(F.col("next.start") < F.col("end"), F.col("next.kind"))
    return over.select(*KEY, "kind", "start", "end", "value", "before", F.when(token, known).alias("known"))


def _patterns(rows: DataFrame) -> DataFrame:
    """A candidate's patterns: the word before it, and the two words before it."""
    words = F.split(F.trim("before"), r"\s+")
    both = F.array_distinct(F.array(F.element_at(words, -1), F.array_join(words, " ")))
    return rows.where(f"kind = {TOKEN} and before <> '' and end > start").withColumn("pattern", F.explode(both))


def confident_patterns(found: DataFrame, *, rounds: int, min_support: int, min_score: float) -> DataFrame:
    """(pattern, as_kind, score) of the high-confidence patterns."""
    rows = _patterns(found).select("pattern", F.lower("value").alias("value"), "known")
    graph = rows.groupBy("pattern", "value").agg(F.min("known").alias("known"))  # summed before the shuffle, however frequent a pattern
    enough = graph.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= min_support).select("pattern")  # others are never supported
    graph = stored(graph.join(enough, "pattern"), "pattern-graph")
    kinds = F.explode(F.array(*[F.lit(k) for k in range(len(KINDS))])).alias("as_kind")
    unknown, fits = F.col("known").isNull(), _shape(F.col("as_kind"), F.col("value"))
    good = None
    for _ in range(rounds):
        edges = graph.select("pattern", "value", "known", kinds)
        if good is None:
            edges = edges.withColumn("found", F.lit(0.0))
        else:
            reach = graph.where("known is null").join(good, "pattern").where(fits).groupBy("value", "as_kind").agg(F.max("score").alias("found"))
            edges = edges.join(reach, ["value", "as_kind"], "left")
        for_it = F.when(F.col("known") == F.col("as_kind"), 1.0).when(unknown, F.coalesce("found", F.lit(0.0))).otherwise(0.0)
        against = F.when(unknown & fits, 0.0).when(F.col("known") == F.col("as_kind"), 0.0).otherwise(1.0)
        scored = edges.groupBy("pattern", "as_kind").agg(F.sum(for_it).alias("support"), F.sum(against).alias("against"))
        scored = scored.where(F.col("support") >= min_support).withColumn("score", F.col("support") / (F.col("support") + F.col("against")))
        good = stored(scored.where(F.col("score") >= min_score).select("pattern", "as_kind", "score"), "good-patterns")
    return good


def spans(given: DataFrame, *, rounds: int = 3, min_support: int = 5, min_score: float = 0.8) -> DataFrame:
    """Per span: key, kind (number), start, end, base (false: found by the method), fresh (where what no earlier span covers begins)."""
    found = stored(matches(given), "pii-matches")
    good = confident_patterns(found, rounds=rounds, min_support=min_support, min_score=min_score)
    open_ = _patterns(found.where("known is null")).join(good, "pattern").where(_shape(F.col("as_kind"), F.col("value")))
    added = open_.groupBy(*KEY, "start", "end").agg(F.max_by("as_kind", F.struct("score", F.negate("as_kind"))).alias("kind"))
    every = found.where(f"kind < {TOKEN}").select(*KEY, "kind", "start", "end", F.lit(True).alias("base")).unionByName(added.select(*KEY, "kind", "start", "end", F.lit(False).alias("base")))
    before = W.partitionBy(*KEY).orderBy("start", "kind", "end").rowsBetween(W.unboundedPreceding, -1)
    return every.withColumn("fresh", F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0))))


def _same_key(left: str, right: str) -> Column:
    return F.expr(" and ".join(f"{left}.{c} <=> {right}.{c}" for c in KEY))


def find_pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3, min_support: int = 5, min_score: float = 0.8) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (kind:start:end by start, then kind), n_added."""
    given = keyed(docs, id_col, text_col)
    every = spans(given, rounds=rounds, min_support=min_support, min_score=min_score)
    names = F.array(*[F.lit(k) for k in KINDS])
    one = F.struct("start", "kind", F.concat_ws(":", names[F.col("kind")], "start", "end").alias("name"))
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(c)), lambda s: s["name"]), ",")
    counts = [F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    by_doc = every.groupBy(*KEY).agg(*counts, F.sha2(joined(F.when(F.col("base"), one)), 256).alias("base_sha256"), joined(one).alias("spans"), F.count(F.when(~F.col("base"), 1)).alias("n_added"))
    out = given.select(*KEY).alias("d").join(by_doc.alias("s"), _same_key("d", "s"), "left")
    numbers = [F.coalesce(f"n_{name}", F.lit(0)).alias(f"n_{name}") for name in KINDS]
    return out.select("d.doc_id", *numbers, F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"), F.coalesce("n_added", F.lit(0)).alias("n_added"))


def mask_pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3, min_support: int = 5, min_score: float = 0.8) -> DataFrame:
    """The documents with every span's text replaced by ``[KIND]``; all columns stay, null texts stay null."""
    key = [F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("hash"), F.octet_length(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("size")]
    every = spans(keyed(docs, id_col, text_col), rounds=rounds, min_support=min_support, min_score=min_score)
    labels = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    cuts = every.where("end > fresh").groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("fresh", "start", "end", labels[F.col("kind")].alias("label")))).alias("cuts"))
    rows = docs.select(F.struct(*key).alias("_k"), F.struct("*").alias("_row"))
    held = rows.join(cuts, F.expr(" and ".join(f"_k.{c} <=> {c}" for c in KEY)), "left")
    text, cut = F.col(f"_row.`{text_col}`"), F.col("cuts")

    def piece(c: Column, i: Column) -> Column:
        prev = F.when(i > 0, F.get(cut, i - 1)["end"]).otherwise(F.lit(0)).cast("int")
        # what overlaps the span before it continues that one's label
        return F.concat(F.substring(text, prev + 1, c["fresh"].cast("int") - prev), F.when(c["fresh"] > c["start"], F.lit("")).otherwise(c["label"]))

    tail = F.substring(text, F.get(cut, F.size(cut) - 1)["end"].cast("int") + 1, F.length(text))
    masked = F.when(cut.isNull(), text).otherwise(F.concat(F.array_join(F.transform(cut, piece), ""), tail))
    return held.withColumn("_new", masked).select(*[F.col("_new").alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
