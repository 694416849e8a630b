"""A sentencepiece BPE model's vocabulary, and cuts of a text that no merge can cross.

A merge always makes a piece of the vocabulary. So where two neighbouring characters stand side by
side in no piece, no merge crosses the place between them, and the text can be encoded apart on
both sides. In particular, if no piece holds a word mark after another character, every word can
be encoded alone.
"""

from __future__ import annotations

import re
from operator import concat

MARK = "▁"
_RUNS = re.compile(f"{MARK}+[^{MARK}]*")


class Pieces:
    """Vocabulary of a model whose normaliser changes nothing but spaces (checked on loading)."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        normal = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))]
        self.ids = {sp.id_to_piece(i): i for i in normal}
        self.text = {i: p for p, i in self.ids.items()}
        self.score = {i: sp.get_score(i) for i in normal}
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(size) if sp.is_byte(i)}
        self.pairs = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.words_apart = not any(p[1] == MARK and p[0] != MARK for p in self.pairs)
        plain = "a  b éﬁ① "  # a normaliser that folds characters or spaces changes this
        if len(self.bytes) != 256 or sp.decode(sp.encode(plain)) != plain:
            raise ValueError("a BPE model with byte fallback and without normalisation is needed")

    def runs(self, text: str) -> list[str]:
        """The text with its leading word mark, cut before each word mark that follows another character."""
        marked = MARK + text.replace(" ", MARK)
        if not self.words_apart:
            return [marked]
        return _RUNS.findall(marked)

    def parts(self, run: str) -> list[str]:
        """A run, cut wherever two neighbours stand side by side in no piece."""
        inside = list(map(self.pairs.__contains__, map(concat, run, run[1:])))
        if False not in inside:
            return [run]
        out, start = [], 0
        for k, joined in enumerate(inside, 1):
            if not joined:
                out.append(run[start:k])
                start = k
        out.append(run[start:])
        return out
