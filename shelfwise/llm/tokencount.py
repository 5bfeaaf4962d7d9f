"""Token counts of a unigram vocabulary without forming tokens: Aho-Corasick matches and a count-only Viterbi."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Memo

VOCABULARY = "piece_bpe_32k.model"
#: a blank as the vocabulary writes it; each begins a word
BLANK = "\u2581"
#: an unknown character's score is this much below the least score
UNKNOWN_PENALTY = 10.0


def read_vocabulary(name: str = VOCABULARY) -> list[tuple[str, float]]:
    """Pieces and scores in order of their ids; control, unknown and byte pieces are left out."""
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    found = range(model.get_piece_size())
    plain = [i for i in found if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return [(model.id_to_piece(i), float(model.get_score(i))) for i in plain]


class UnigramCounter:
    """Score and number of pieces of the best segmentation of a word.

    Matches of the vocabulary come from one pass of an Aho-Corasick automaton, longest
    first at each end. Each position carries the best score up to it and its number of
    pieces. Ties as in the public unigram tokenizers: the segmentation whose last piece
    starts first stays, for each position. A character that is no piece itself may also be
    unknown, at UNKNOWN_PENALTY below the least score; it counts as its UTF-8 bytes, as
    vocabularies with byte pieces write it. Pieces may hold a blank at their start only,
    so words are independent and a word's result is remembered.
    """

    def __init__(self, vocabulary: list[tuple[str, float]], memory: int = 500_000) -> None:
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if BLANK not in piece[1:]:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {piece for piece, _ in vocabulary if len(piece) == 1}
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.memo = Memo(self.word, memory)

    def word(self, word: str) -> tuple[float, int, int]:
        """Score, pieces and unknown characters."""
        size = len(word)
        best: list[tuple[float, int, int] | None] = [None] * (size + 1)
        best[0] = (0.0, 0, 0)
        matches = self.automaton.iter(word)
        end, match = next(matches, (size, None))
        for at in range(size):
            top = None
            while end == at:
                length, score = match
                before = best[at + 1 - length]
                total = before[0] + score
                if top is None or total > top[0]:
                    top = (total, before[1] + 1, before[2])
                end, match = next(matches, (size, None))
            if word[at] not in self.single:
                before = best[at]
                total = before[0] + self.unknown
                if top is None or total > top[0]:
                    width = len(word[at].encode("utf-8", "surrogatepass"))
                    top = (total, before[1] + width, before[2] + 1)
            best[at + 1] = top
        return best[size]

    def text(self, text: str | None) -> tuple[int, float, int]:
        """Pieces, score and unknown characters of a whole text, with a blank put before it."""
        if not text:
            return 0, 0.0, 0
        words = (BLANK + w for w in text.replace(BLANK, " ").split(" "))
        # a text that begins with a blank gets no second one
        if text[0] in (" ", BLANK):
            next(words)
        found = list(map(self.memo.__getitem__, words))
        scores, pieces, unknown = zip(*found, strict=True)
        return sum(pieces), float(sum(scores)), sum(unknown)


_COUNTERS: dict[str, UnigramCounter] = {}


def counter(name: str) -> UnigramCounter:
    """One counter a process; its memory of words serves all tasks."""
    if name not in _COUNTERS:
        _COUNTERS[name] = UnigramCounter(read_vocabulary(name))
    return _COUNTERS[name]


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, score and n_unknown (characters) of each row of docs.

    Null and empty texts have no tokens and a score of 0. No row meets another: nothing is
    shuffled, and memory is that of one text and the remembered words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary).text
        for batch in batches:
            found = [count(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.array([f[0] for f in found], dtype=np.int64)),
                    pa.array(np.array([f[1] for f in found], dtype=np.float64)),
                    pa.array(np.array([f[2] for f in found], dtype=np.int64)),
                ],
                names=["doc_id", "n_tokens", "score", "n_unknown"],
            )

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return given.mapInArrow(run, "doc_id long, n_tokens long, score double, n_unknown long")
