"""SentencePiece encoding by backtracking, and decoding.

An encoding of merge type is valid exactly if each two neighbouring tokens are the encoding of
their joined text. So the encoder takes, from left to right, the longest piece that an
Aho-Corasick automaton finds at a place and that is compatible with the token before it; where
none fits it marks the place as failed in a bitfield and goes back to the next shorter piece.
Two tokens are compatible if re-merging along their common edge, in order of the merges' scores,
never joins a symbol of one with a symbol of the other. No library merge loop is used for the ids.

Cases: a null or empty text gives no ids and an empty decoded text; characters outside the
vocabulary become byte ids; rows repeat as given; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain
from string import ascii_letters

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from surveyspark.llm.common import Memo, batch_of, id_and_text, slices
from surveyspark.llm.pieces import MARK, Pieces

LAST = float("inf")
#: Words and parts kept, and their characters at most: with the pairs of pieces kept this bounds a worker's memory.
LIMIT, LONGEST = 120_000, 64
#: Stands before a run that starts at a mark; a private-use character, and texts that hold it are cut at word marks only.
CUT = "\ue000"


class BacktrackingEncoder:
    """Ids of texts for the model at ``path``. Words, and parts of long ones, are kept (about twice ``limit`` each at most)."""

    def __init__(self, path: str, limit: int = LIMIT):
        self.pieces = Pieces(path)
        ids, score = self.pieces.ids, self.pieces.score
        self.rank = {p: -score[i] for p, i in ids.items()}
        self.edges: dict[str, tuple] = {}
        self.automaton = ahocorasick.Automaton()
        for p in ids:
            self.automaton.add_word(p, len(p))
        self.automaton.make_automaton()
        self.most = max(map(len, ids))
        self.names = list(map(str, range(self.pieces.sp.get_piece_size())))
        self.shorter = Memo(self._next_shorter)  # one entry for each piece at most, and the characters outside
        self.fits = Memo(self._compatible, LIMIT)
        self.part_ids = Memo(self._encode_part, limit, LONGEST)
        self.run_ids = Memo(self._encode_run, limit, LONGEST)

        # a mark after a letter starts a run of its own where no piece holds the two side by side: fewer runs differ
        pairs = self.pieces.pairs
        marks = [m for m in ",.;:!?\n" if not any(c + m in pairs for c in ascii_letters)]
        letters = [c for c in map(chr, range(0x41, 0x250)) if c.isalpha() and not any(c + m in pairs for m in marks)]
        # the mark comes first in the pattern: the search skips to it
        self.cut = re.compile(f"[{''.join(marks)}](?<=[{''.join(letters)}].)", re.DOTALL) if marks and letters else None
        self.cut_runs = re.compile(f"{MARK}+[^{MARK}{CUT}]*|{CUT}[^{MARK}{CUT}]*")

    def _runs(self, text: str) -> list[str]:
        """Runs by their text: a word without its one word mark, a run that starts at a cut after CUT, any other with its word marks."""
        if self.cut is None or CUT in text or not self.pieces.words_apart:
            return self.pieces.runs(text)
        if MARK in text or "  " in text or text[0] == " ":  # some run has several word marks
            return self.cut_runs.findall(self.cut.sub(rf"{CUT}\g<0>", MARK + text.replace(" ", MARK)))
        return self.cut.sub(rf" {CUT}\g<0>", text).split(" ")

    # -- merges of a single piece ------------------------------------------------------------
    def _split(self, piece: str) -> tuple[str, str] | None:
        """The two symbols whose merge makes the piece; None if merging its text ends otherwise."""
        symbols = list(piece)
        while len(symbols) > 2:
            best, at = LAST, -1
            for k in range(len(symbols) - 1):
                r = self.rank.get(symbols[k] + symbols[k + 1], LAST)
                if r < best:
                    best, at = r, k
            if at < 0:
                return None
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return tuple(symbols) if len(symbols) == 2 else None

    def _edge(self, piece: str) -> tuple | None:
        """What stands at the piece's left and right edge while it is merged: (symbol, rank of the merge that takes it up), in order of time."""
        if piece in self.edges:
            return self.edges[piece]
        if len(piece) == 1:
            out = (((piece, LAST),), ((piece, LAST),))
        else:
            halves, out = self._split(piece), None
            if halves:
                left, right, r = self._edge(halves[0]), self._edge(halves[1]), self.rank[piece]
                if left and right:
                    out = ((*left[0][:-1], (halves[0], r), (piece, LAST)), (*right[1][:-1], (halves[1], r), (piece, LAST)))
        self.edges[piece] = out
        return out

    def _compatible(self, pair: tuple[str, str]) -> bool:
        """Whether re-merging the joined text keeps the two pieces apart. Of equal merges the left one comes first."""
        a, b = self._edge(pair[0]), self._edge(pair[1])
        if a is None or b is None:
            return False
        a, b, i, j = a[1], b[0], 0, 0
        while True:
            (x, x_end), (y, y_end) = a[i], b[j]
            r = self.rank.get(x + y, LAST)
            if r < x_end and r <= y_end:
                return False
            if x_end == LAST and y_end == LAST:
                return True
            if x_end <= y_end:
                i += 1
            else:
                j += 1

    # -- encoding ----------------------------------------------------------------------------
    def _next_shorter(self, piece: str) -> str:
        """The longest piece that the piece starts with, or its first character; empty for a single character."""
        end, ids = len(piece) - 1, self.pieces.ids
        while end > 1 and piece[:end] not in ids:
            end -= 1
        return piece[:end]

    def _tokens(self, text: str) -> list[str]:
        fits, shorter, prefix, ids, most = self.fits, self.shorter, self.automaton.longest_prefix, self.pieces.ids, self.most
        n, tokens, pos, failed, last = len(text), [], 0, 0, None
        while True:
            rest = text[pos : pos + most]
            end = prefix(rest)  # of a path to a piece, so shorter ones may have to be tried
            piece = rest[: end or 1]  # a character outside the vocabulary stands alone
            while end > 1 and piece not in ids:
                end -= 1
                piece = rest[:end]
            while True:
                while piece:
                    end = pos + len(piece)
                    if not failed >> end & 1 and (fits[last, piece] if tokens else len(piece) == 1 or self._edge(piece) is not None):
                        break
                    piece = shorter[piece]
                if piece:
                    break
                failed |= 1 << pos
                if not tokens:
                    raise ValueError("no valid encoding")
                piece = tokens.pop()
                last = tokens[-1] if tokens else None
                pos -= len(piece)
                piece = shorter[piece]
            tokens.append(piece)
            if end == n:
                return tokens
            pos, last = end, piece

    def _encode_part(self, part: str) -> tuple[int, ...]:
        ids, by_byte = self.pieces.ids, self.pieces.bytes
        tokens = self._tokens(part)
        try:
            return tuple([ids[t] for t in tokens])
        except KeyError:
            return tuple(chain.from_iterable((ids[t],) if t in ids else [by_byte[b] for b in t.encode()] for t in tokens))

    def _encode_run(self, run: str) -> tuple[tuple[int, ...], str]:
        run = run[1:] if run.startswith(CUT) else run if run.startswith(MARK) else MARK + run
        if len(run) <= LONGEST:  # no token crosses the cuts between parts anyway; only long runs are searched part by part
            ids = self._encode_part(run)
        else:
            ids = tuple(chain.from_iterable(map(self.part_ids.__getitem__, self.pieces.parts(run))))
        return ids, ",".join([self.names[i] for i in ids])

    def encode(self, text: str) -> tuple[list[int], str]:
        """The ids, and the same in decimal joined by commas."""
        if not text:
            return [], ""
        self.trim()
        coded = list(map(self.run_ids.__getitem__, self._runs(text)))
        return list(chain.from_iterable([c[0] for c in coded])), ",".join([c[1] for c in coded])

    def decode(self, ids: list[int]) -> str:
        return self.pieces.sp.decode(ids)

    def trim(self) -> None:
        """Before each text, so that the memory is bounded by the limit and one text, not by how texts are batched."""
        for memo in (self.shorter, self.fits, self.part_ids, self.run_ids):
            memo.trim()


CODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("ids_sha256", pa.string()), ("decoded", pa.string()), ("decoded_sha256", pa.string())])


SQL_TYPES = {"doc_id": "long", "n_tokens": "long", "ids": "array<int>", "ids_sha256": "string", "decoded": "string", "decoded_sha256": "string"}


def _code(path: str, columns: tuple[str, ...]):
    schema = pa.schema([CODED.field(c) for c in columns])
    at = [CODED.names.index(c) for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = BacktrackingEncoder(path)
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, name = encoder.encode(text or "")
                decoded = encoder.decode(ids) if ids else ""
                row = (doc_id, len(ids), ids, hashlib.sha256(name.encode()).hexdigest(), decoded, hashlib.sha256(decoded.encode()).hexdigest())
                rows.append([row[k] for k in at])
            yield batch_of(schema, *zip(*rows, strict=True))

    return run


def encode_decode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", columns: tuple[str, ...] = tuple(SQL_TYPES)) -> DataFrame:
    """Per row: doc_id, n_tokens, ids, ids_sha256, decoded, decoded_sha256, or those named in ``columns``."""
    return id_and_text(docs, id_col, text_col).mapInArrow(_code(path, columns), ", ".join(f"{c} {SQL_TYPES[c]}" for c in columns))


__all__ = ["MARK", "BacktrackingEncoder", "encode_decode"]
