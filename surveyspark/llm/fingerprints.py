"""Document fingerprints (13): invertible Bloom lookup sketches of paragraph digests, by DataFrame functions only.

A text is cut into paragraphs (lines and sentences, long ones at PIECE characters); each distinct paragraph has a 64-bit
digest whose low CHECK bits are a check of the others. A sketch has TABLES sub-tables of cells (count, xor of digests);
each digest lies in one cell of each. The difference of two versions' sketches, cell by cell, holds only the digests that
differ; a cell with one digest gives it away, and taking it out of its other cells frees the next (peeling). The
fingerprint is a sketch of fixed size. Where the difference of two fingerprints does not peel, larger sketches are tried:
the digests' range is cut into parts of about LOAD digests, each with sketches of its own, doubled with other cells until
they peel. So the work is linear in the paragraphs, and each likeness is exact.

The next document comes from a window over buckets of neighbouring ids: one shuffle of the texts. Bucket bounds are rows'
own places in the order (at most BOUNDS of them), and each bucket also gets a copy of the row behind its last."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyspark.llm.ranks import ranked

#: Characters of a paragraph piece at most; sub-tables of a sketch, cells of each in the fingerprint; check bits.
PIECE, TABLES, CELLS, CHECK = 120, 3, 8, 24

#: Digests that a part of a larger sketch holds on average (of both versions), attempts (each doubles the cells).
LOAD, ATTEMPTS = 12, 10

#: Buckets of neighbouring documents: rows of one at least, and number of bounds at most.
BUCKET_ROWS, BOUNDS = 1024, 1 << 14

PARAGRAPH = r"[^\n.!?]{0,%d}+[\n.!?]{1,40}|[^\n.!?]{1,%d}" % (PIECE, PIECE)


def let(name: str, value: str, body: str) -> str:
    """SQL: ``body`` with ``name`` bound to ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def digests(text: Column) -> Column:
    """The distinct paragraph digests of a text, ascending. Every character lies in a paragraph; an empty text has none."""
    low = (1 << CHECK) - 1

    def digest(piece: Column) -> Column:
        h = F.xxhash64(piece)
        return h.bitwiseAND(F.lit(~low)).bitwiseOR(F.xxhash64(F.shiftright(h, CHECK)).bitwiseAND(F.lit(low)))

    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)), digest)))


def places(key: str, size: str, seed: str) -> str:
    """SQL: the cells of a digest, one in each sub-table of ``size`` cells."""
    cell = [f"{t} * {size} + (shiftrightunsigned(h_, {20 * t}) & ({size} - 1))" for t in range(TABLES)]
    return let("h_", f"xxhash64({key}, {seed})", f"array({', '.join(cell)})")


def cells(keys: str, size: str, seed: str) -> str:
    """SQL: the sketch of an array of digests: array<struct<n int, x bigint>> of TABLES * size cells."""
    cell = let("m_", "filter(p_, e_ -> array_contains(e_.p, i_))", "struct(size(m_) AS n, aggregate(m_, 0L, (x_, e_) -> x_ ^ e_.k) AS x)")
    return let("p_", f"transform({keys}, k_ -> struct(k_ AS k, {places('k_', size, seed)} AS p))", f"transform(sequence(0L, {TABLES} * {size} - 1L), i_ -> {cell})")


def minus(a: str, b: str) -> str:
    return f"zip_with({a}, {b}, (a_, b_) -> struct(a_.n - b_.n AS n, a_.x ^ b_.x AS x))"


def peeled(difference: str, size: str, seed: str) -> str:
    """SQL: struct(ok, a, b) of a difference: whether it peeled to nothing, and how many digests each side alone has.

    A round takes out all digests that stand alone in a cell; rounds end when none does (each takes one at least, and
    there are at most as many as cells)."""
    pure = f"filter(s_.c, q_ -> abs(q_.n) = 1 AND (xxhash64(shiftright(q_.x, {CHECK})) & {(1 << CHECK) - 1}) = (q_.x & {(1 << CHECK) - 1}))"
    found = f"transform(array_distinct(u_), k_ -> struct(k_.n AS n, k_.x AS x, {places('k_.x', size, seed)} AS p))"
    without = "transform(s_.c, (c_, i_) -> aggregate(w_, c_, (z_, f_) -> if(array_contains(f_.p, CAST(i_ AS BIGINT)), struct(z_.n - f_.n AS n, z_.x ^ f_.x AS x), z_)))"
    taken = f"struct(true AS more, s_.a + size(filter(w_, f_ -> f_.n > 0)) AS a, s_.b + size(filter(w_, f_ -> f_.n < 0)) AS b, {without} AS c)"
    none = "struct(false AS more, s_.a AS a, s_.b AS b, s_.c AS c)"
    step = f"if(s_.more, {let('u_', pure, f'if(size(u_) = 0, {none}, ' + let('w_', found, taken) + ')')}, s_)"
    start = f"struct(true AS more, 0 AS a, 0 AS b, {difference} AS c)"
    end = "struct(forall(s_.c, q_ -> q_.n = 0 AND q_.x = 0L) AS ok, s_.a AS a, s_.b AS b)"
    return f"aggregate(sequence(1L, {TABLES} * {size}), {start}, (s_, r_) -> {step}, s_ -> {end})"


def attempt(a: str, b: str, t: str) -> str:
    """SQL: the ``t``-th attempt at two arrays of digests, with cells doubled each time; counts must agree with the sizes."""
    size = f"shiftleft({CELLS}L, {t} - 1)"
    got = peeled(minus(cells(a, size, t), cells(b, size, t)), size, t)
    return let("g_", got, f"struct(g_.ok AND size({a}) - g_.a = size({b}) - g_.b AS ok, g_.a AS a, g_.b AS b)")


def edges(keys: str, parts: str) -> str:
    """SQL: where each of 2^parts equal ranges of longs begins in an ascending array (from 0), and the array's size."""
    bound = f"(shiftleft(CAST(j_ AS BIGINT), 64 - {parts}) ^ CAST('-9223372036854775808' AS BIGINT))"
    half = "shiftright(z_.lo + z_.hi, 1)"
    step = f"if(z_.lo = z_.hi, z_, if(element_at({keys}, {half} + 1) < {bound}, struct({half} + 1 AS lo, z_.hi AS hi), struct(z_.lo AS lo, {half} AS hi)))"
    below = f"aggregate(sequence(0, CAST(log2(size({keys}) + 1) AS INT)), struct(0 AS lo, size({keys}) AS hi), (z_, r_) -> {step}, z_ -> z_.lo)"
    return f"transform(sequence(0, shiftleft(1, {parts})), j_ -> CASE WHEN j_ = 0 THEN 0 WHEN j_ = shiftleft(1, {parts}) THEN size({keys}) ELSE {below} END)"


def differing(a: str, b: str) -> str:
    """SQL: struct(ok, a, b) by larger sketches: parts of about LOAD digests, each tried until it peels."""
    parts = f"CAST(least(25, greatest(1, ceil(log2((size({a}) + size({b})) / {float(LOAD)})))) AS INT)"
    tries = f"aggregate(sequence(1, {ATTEMPTS}), struct(false AS ok, 0 AS a, 0 AS b), (y_, t_) -> if(y_.ok, y_, {attempt('v_.a', 'v_.b', 't_')}))"
    both = "struct(" + ", ".join(f"slice({k}, d_.{n}[j_] + 1, d_.{n}[j_ + 1] - d_.{n}[j_]) AS {n}" for n, k in (("a", a), ("b", b))) + ")"
    total = "(y_, g_) -> struct(y_.ok AND g_.ok AS ok, y_.a + g_.a AS a, y_.b + g_.b AS b)"
    summed = f"aggregate(transform(sequence(0, shiftleft(1, n_) - 1), j_ -> {let('v_', both, tries)}), struct(true AS ok, 0 AS a, 0 AS b), {total})"
    return let("n_", parts, let("d_", f"struct({edges(a, 'n_')} AS a, {edges(b, 'n_')} AS b)", summed))


def sketch(keys: str) -> str:
    """SQL: the fingerprint's cells."""
    return cells(keys, f"{CELLS}L", "1")


def compared(a: str, b: str, cells_a: str, cells_b: str) -> str:
    """SQL: Jaccard likeness of two versions' paragraphs from what peeling recovers; two versions without any are alike.

    ``a``, ``b``: their digests, for larger sketches; ``cells_a``, ``cells_b``: their fingerprints' cells."""
    small = peeled(minus(cells_a, cells_b), f"{CELLS}L", "1")
    either = let("o_", small, f"if(o_.ok AND size({a}) - o_.a = size({b}) - o_.b, o_, {differing(a, b)})")
    share = f"if(size({a}) + o_.b = 0, 1.0D, CAST(size({a}) - o_.a AS DOUBLE) / (size({a}) + o_.b))"
    return let("o_", either, f"if(o_.ok, {share}, CAST(NULL AS DOUBLE))")


def written(cells_: str, keys: str) -> str:
    """SQL: a fingerprint as text: the number of digests, then each cell's count and xor, in hex."""
    cell = "concat(lpad(lower(hex(c_.n)), 8, '0'), lpad(lower(hex(c_.x)), 16, '0'))"
    return f"concat(lower(hex(size({keys}))), ':', array_join(transform({cells_}, c_ -> {cell}), ''))"


def with_next(df: DataFrame, id_col: str, text_col: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, text, own, cells, next): each row, its digests and fingerprint's cells, and a struct of the same three of
    the next one in descending id order; the last one's next is the first.

    Null ids come last (with the least long); rows of one id stand in the order of a hash of their texts, and repeated rows one after the other."""
    least = F.lit((1 << 63) - 1)  # the place of null ids
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumns({"id": F.coalesce(F.bitwise_not("doc_id"), least), "hash": F.xxhash64("text")})
    order = ranked(docs.select(F.lit(0).alias("all"), "id", "hash"), "all", [F.col("id"), F.col("hash")], rank="r", size="n")
    every = F.greatest(F.lit(bucket_rows), F.ceil(F.col("n") / BOUNDS))
    bounds = sorted({(x["id"], x["hash"]) for x in order.filter(F.col("r") % every == 0).select("id", "hash").collect()})  # at most BOUNDS pairs of longs
    ids, hashes = (F.lit(np.array([x[k] for x in bounds], dtype=np.int64)) for k in (0, 1))

    def bisect(z: Column, _: Column) -> Column:
        half = F.shiftright(z["lo"] + z["hi"] + 1, 1)
        at, by = F.element_at(ids, half), F.element_at(hashes, half)
        lower = (at < F.col("id")) | ((at == F.col("id")) & (by <= F.col("hash")))
        return F.struct(F.when(lower, half).otherwise(z["lo"]).alias("lo"), F.when(lower, z["hi"]).otherwise(F.greatest(half - 1, z["lo"])).alias("hi"))

    steps = F.sequence(F.lit(0), F.lit(max(1, len(bounds)).bit_length()))
    span = F.struct(F.lit(1).alias("lo"), F.lit(max(1, len(bounds))).alias("hi"))
    found = docs.withColumn("bucket", F.aggregate(steps, span, bisect, lambda z: z["lo"]))
    # the first of each bucket also stands behind the last of the bucket before; the very first behind the very last
    first = (F.col("id") == F.element_at(ids, F.col("bucket"))) & (F.col("hash") == F.element_at(hashes, F.col("bucket")))
    own = F.struct(F.col("bucket").alias("b"), F.lit(False).alias("copy"))
    before = F.when(F.col("bucket") == 1, F.lit(len(bounds))).otherwise(F.col("bucket") - 1)
    rows = found.select("doc_id", "text", "id", "hash", F.inline(F.when(first, F.array(own, F.struct(before.alias("b"), F.lit(True).alias("copy")))).otherwise(F.array(own))))
    # only texts are shuffled; digests and cells are made once for each row, where its bucket lies
    rows = rows.repartition("b").withColumn("own", digests(F.col("text"))).withColumn("cells", F.expr(sketch("own")))
    after = F.lead(F.struct("text", "own", "cells")).over(Window.partitionBy("b").orderBy("copy", "id", "hash"))
    return rows.withColumn("next", after).filter(~F.col("copy")).select("doc_id", "text", "own", "cells", "next")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last half (rounded down) replaced by as much of the next document's beginning. Nulls and empty
    texts have no paragraphs: their fingerprint is the empty sketch, their likeness to each other 1. Very long texts are
    read whole. Rows of one id follow each other by text, repeated rows too (a row alone is its own next). An empty table
    gives no rows; further columns are not read. A likeness would be null if no attempt peeled; two digests that share
    their cells under all ATTEMPTS seeds and sizes would be needed."""
    rows = with_next(df, id_col, text_col, bucket_rows).withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("edited", F.expr("concat(substring(text, 1, n_chars - n_chars div 2), substring(next.text, 1, n_chars div 2))"))
    sets = rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), F.struct(
        "own", "cells", digests(F.col("edited")).alias("edited"), F.col("next.own").alias("next"), F.col("next.cells").alias("next_cells")).alias("k"))
    done = sets.select("doc_id", "n_chars", "edited_sha256", F.expr(let("c", sketch("k.edited"),
        f"struct({written('k.cells', 'k.own')} AS fingerprint, {written('c', 'k.edited')} AS edited_fingerprint, "
        f"{compared('k.own', 'k.edited', 'k.cells', 'c')} AS near_edited, {compared('k.own', 'k.next', 'k.cells', 'k.next_cells')} AS near_next)")).alias("r"))
    return done.select("doc_id", "n_chars", "edited_sha256", "r.*")
