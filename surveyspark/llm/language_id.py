"""Language ID by error-correcting output codes.

Each language has a codeword. For each bit a binary naive-Bayes classifier over hashed byte n-grams
(1 to 3 bytes, A-Z lower-cased) tells the languages with that bit from those without. A text's margins
(mean log odds per n-gram, scaled so that every language's own expected margin is at least 1) are
decoded to the codeword of least loss, sum of w_bit * exp(-codeword bit * margin), where w_bit is how
far apart the classifier holds its two groups. If the second-best codeword's loss is less than
``ambiguous_below`` away, the row is flagged.

The classifiers are fitted on the n-gram counts of every labelled row that is not held out, whole; the
counts are added up in the tasks, and only their totals (languages x 2^13) meet. All texts are predicted whole.

Cases: a null text, or one without a letter, is ``und`` with score 0; a null doc_id is not held out and
not learned from; a null lang is not learned from; with nothing learned every text is ``und``; with one
language learned it is that one with score 1; ties go to the language that sorts first.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyspark.llm.common import batch_of, slices

BITS = 13
#: A text of n bytes may lose SHORT / n more than others; the bound lies MARGIN over the greatest loss of held-out rows.
SHORT, MARGIN = 0.3, 0.02
#: Bytes of a text that are held as n-gram codes at a time (every byte is used).
STEP = 1 << 16


def ngram_codes(data: bytes) -> Iterator[np.ndarray]:
    """Hashed 1-, 2- and 3-grams of the bytes, in steps that overlap by two bytes."""
    mult = np.uint32(2654435761)
    for at in range(0, max(len(data), 1), STEP):
        b = np.frombuffer(data[at : at + STEP + 2], dtype=np.uint8).astype(np.uint32)
        own = min(STEP, len(data) - at)
        two = b[:-1] << np.uint32(8) | b[1:]
        three = two[:-1] << np.uint32(8) | b[2:]
        grams = [b[:own] + np.uint32(1 << 25), two[:own] + np.uint32(1 << 24), three[:own]]
        yield (np.concatenate(grams) * mult) >> np.uint32(32 - BITS)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def codewords(n: int) -> np.ndarray:
    """n rows of +1/-1: all dichotomies for few languages, else the seeded random code with the largest least distance."""
    if n <= 6:
        columns = [(1, *c) for c in itertools.product((1, -1), repeat=n - 1) if -1 in c]
        return np.array(columns, dtype=float).T.reshape(n, -1)
    size, best, best_d = math.ceil(12 * math.log2(n)), None, -1
    for seed in range(200):
        code = np.random.default_rng(seed).choice([-1.0, 1.0], size=(n, size))
        code = np.unique(code[:, np.abs(code.sum(0)) < n], axis=1)
        d = min(int((code[i] != code[j]).sum()) for i, j in itertools.combinations(range(n), 2))
        if d > best_d:
            best, best_d = code, d
    return best


@dataclass
class CodeModel:
    langs: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # n-gram codes x bits, log odds
    bias: np.ndarray
    gap: np.ndarray

    def losses(self, data: bytes) -> np.ndarray:
        total, n = np.zeros(self.code.shape[1]), 0
        for codes in ngram_codes(data):
            total += self.weights[codes].sum(0)
            n += len(codes)
        margins = np.clip((total / max(n, 1) - self.bias) / self.gap, -3, 3)
        return (np.exp(-self.code * margins) * self.gap).sum(1) / self.gap.sum()

    def distance(self, text: str | None) -> float | None:
        """The loss of the nearest codeword, less what a short text may lose; None without a language or a letter."""
        if not self.langs or not has_letter(text):
            return None
        data = text.encode().lower()
        return 0.0 if len(self.langs) == 1 else float(self.losses(data).min()) - SHORT / len(data)

    def read(self, text: str | None, ambiguous_below: float) -> tuple[str, float, bool, float | None]:
        """Language, score, whether it is ambiguous (as ``predict``), and ``distance``, from one look at the text."""
        if not self.langs or not has_letter(text):
            return "und", 0.0, True, None
        if len(self.langs) == 1:
            return self.langs[0], 1.0, False, 0.0
        data = text.encode().lower()
        loss = self.losses(data)
        order = np.argsort(loss, kind="stable")
        p = np.exp(4 * (loss[order[0]] - loss))
        ambiguous = bool(loss[order[1]] - loss[order[0]] < ambiguous_below)
        return self.langs[order[0]], float(1 / p.sum()), ambiguous, float(loss[order[0]]) - SHORT / len(data)

    def predict(self, text: str | None, ambiguous_below: float) -> tuple[str, float, bool]:
        return self.read(text, ambiguous_below)[:3]


def fit(langs: list[str], counts: np.ndarray) -> CodeModel:
    """The bit classifiers from each language's n-gram counts (languages x codes)."""
    if len(langs) < 2:
        return CodeModel(langs, np.ones((len(langs), 0)), np.zeros((1 << BITS, 0)), np.zeros(0), np.zeros(0))
    q = (counts + 0.5) / (counts + 0.5).sum(1, keepdims=True)
    code = codewords(len(langs))
    odds, bias, gap = [], [], []
    for bit in code.T:
        w = np.log(q[bit > 0].mean(0)) - np.log(q[bit < 0].mean(0))
        own = q @ w
        low, high = own[bit > 0].min(), own[bit < 0].max()
        odds.append(w)
        bias.append((low + high) / 2)
        gap.append(max((low - high) / 2, 1e-3))
    return CodeModel(langs, code, np.array(odds).T.copy(), np.array(bias), np.array(gap))


GRAMS = pa.schema([("lang", pa.string()), ("code", pa.int32()), ("n", pa.int64())])


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in slices(batches):
        for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if has_letter(text):
                total = totals.setdefault(lang, np.zeros(1 << BITS, dtype=np.int64))
                for codes in ngram_codes(text.encode().lower()):
                    total += np.bincount(codes, minlength=1 << BITS)
    for lang, total in totals.items():
        at = np.flatnonzero(total)
        yield batch_of(GRAMS, [lang] * len(at), at, total[at])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _labelled(docs: DataFrame, id_col: str, text_col: str, lang_col: str, held: bool) -> DataFrame:
    """(lang, text) of all labelled rows, held out or not."""
    key = F.col(id_col)
    mine = held_out(key) if held else ~held_out(key)
    rows = docs.where(key.isNotNull() & F.col(lang_col).isNotNull() & mine)
    return rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> CodeModel:
    """Learns from all rows with a lang whose crc32(doc_id) mod 4 is not 2."""
    rows = _labelled(docs, id_col, text_col, lang_col, held=False)
    grams = rows.mapInArrow(_count_grams, "lang string, code int, n long")
    got = grams.groupBy("lang", "code").agg(F.sum("n").alias("n")).toPandas()  # languages x 2^13 rows at most
    langs = sorted(got["lang"].unique())
    counts = np.zeros((len(langs), 1 << BITS))
    counts[[langs.index(x) for x in got["lang"]], got["code"].to_numpy(dtype=int)] = got["n"]
    return fit(langs, counts)


PREDICTED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])


def identify(docs: DataFrame, model: CodeModel | None = None, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", ambiguous_below: float = 0.1) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score (0 to 1), ambiguous. Without a ``model`` it learns one from ``docs``."""
    model = model or train(docs, id_col=id_col, text_col=text_col, lang_col=lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, out, texts = (c.to_pylist() for c in batch.columns)
            yield batch_of(PREDICTED, ids, out, *zip(*[model.predict(t, ambiguous_below) for t in texts], strict=True))

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")


def farthest(model: CodeModel, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> float | None:
    """The greatest ``distance`` of all held-out labelled rows; None without any."""
    schema = pa.schema([("distance", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch_of(schema, [model.distance(t) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()])

    rows = _labelled(docs, id_col, text_col, lang_col, held=True)
    return rows.mapInArrow(run, "distance double").agg(F.max("distance")).first()[0]


def keep_identified(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", ambiguous_below: float = 0.1) -> DataFrame:
    """The rows whose text is in a learned language, with all their columns: every text is identified as by ``identify``;
    those that are ``und`` go, and those farther from every codeword than any held-out labelled row (``farthest``, and MARGIN
    over it): noise, other scripts, languages that share little with the learned ones. A row that stays without a lang gets
    the one it was identified as, a label that is given stays. Null and empty texts go; rows that repeat share their fate;
    with one language learned, or no row held out, every text with a letter stays, with none learned all go; an empty table
    stays one."""
    same = {"id_col": id_col, "text_col": text_col, "lang_col": lang_col}
    model = train(docs, **same)
    bound = farthest(model, docs, **same)
    limit = math.inf if bound is None else bound + MARGIN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            found = [model.read(t, ambiguous_below) for t in texts]
            at = batch.schema.get_field_index(lang_col)
            langs = pc.coalesce(batch.column(at), pa.array([lang for lang, *_ in found]).cast(batch.schema.field(at).type))
            batch = batch.set_column(at, batch.schema.field(at), langs)
            yield batch.filter(pa.array([lang != "und" and far <= limit for lang, *_, far in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
