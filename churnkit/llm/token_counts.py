"""Token counts of a unigram model without building the tokens.

An Aho-Corasick automaton lists every vocabulary piece that ends at each character. The best path to each character
carries its score and the number of its pieces, nothing else, so a word costs one pass and no back-tracking.

The rules are those of a unigram tokenizer that puts U+2581 before the text and for each space, and splits in front
of it: scores are added from the left as 64-bit floats; of paths with equal scores the one whose last piece is longest
wins, since it is met first and only a greater score replaces it; a character that is no piece itself can be passed at
10 below the lowest score, and such characters in a row count as one piece. Pieces never cross a word's start, so a text's
count is the sum of its words' counts, and these are kept for the next texts, up to ``_MEMORY`` words a worker.

The vocabulary is a file of pieces and scores, a parameter. Defined cases: a null text has a null count, an empty one 0;
repeated rows are counted each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import cache

import ahocorasick
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from churnkit.llm.common import batch, read_table
from churnkit.llm.registry import query

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
_UNKNOWN_PENALTY = 10.0
_MEMORY = 400_000


@cache
def vocabulary(path: str = VOCABULARY) -> dict[str, float]:
    """Ordinary pieces of a SentencePiece file and their scores; control and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return {model.id_to_piece(i): model.get_score(i) for i in ids}


class Counter(dict):
    """Word -> number of pieces, worked out when first asked for."""

    def __init__(self, pieces: Mapping[str, float], memory: int = _MEMORY):
        super().__init__()
        self.memory = memory
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.items():
            self.automaton.add_word(piece, (len(piece), float(score)))
        self.automaton.make_automaton()
        self.singles = {p for p in pieces if len(p) == 1}
        self.unknown = min(pieces.values()) - _UNKNOWN_PENALTY

    def __missing__(self, word: str) -> int:
        if len(self) >= self.memory:
            self.clear()
        n = self[word] = self.viterbi(word)
        return n

    def viterbi(self, word: str) -> int:
        size = len(word)
        score: list = [None] * (size + 1)
        count = [0] * (size + 1)
        passed = [False] * (size + 1)  # the best path to here ends in an unknown character
        score[0] = 0.0
        done = 0  # all paths to characters up to here are final
        singles, unknown = self.singles, self.unknown

        def pass_unknown(upto: int, done: int) -> int:
            # A path to ``end`` through an unknown character is offered after all pieces that end there.
            while done < upto:
                done += 1
                if word[done - 1] not in singles:
                    offer = score[done - 1] + unknown
                    if score[done] is None or offer > score[done]:
                        score[done] = offer
                        count[done] = count[done - 1] + (not passed[done - 1])
                        passed[done] = True
            return done

        for last, (length, own) in self.automaton.iter(word):  # by end, longest first
            end = last + 1
            if end - 1 > done:
                done = pass_unknown(end - 1, done)
            start = end - length
            offer = score[start] + own
            if score[end] is None or offer > score[end]:
                score[end] = offer
                count[end] = count[start] + 1
                passed[end] = False
        pass_unknown(size, done)
        return count[size]

    def text(self, text: str) -> int:
        if not text:
            return 0
        marked = text.replace(" ", SPACE)
        head, *rest = marked.split(SPACE)
        # The text's first word gets a mark of its own unless the text begins with one.
        total = self[SPACE + head] if head else 0
        for word in rest:
            total += self[SPACE + word]
        return total


@cache
def _counter(path: str) -> Counter:
    return Counter(vocabulary(path))


def count_tokens(docs: DataFrame, vocabulary_path: str = VOCABULARY) -> DataFrame:
    """doc_id, n_chars (code points) and n_tokens of every text."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("n_tokens", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary_path)
        for b in batches:
            texts = b.column("text").to_pylist()
            chars = [None if t is None else len(t) for t in texts]
            tokens = [None if t is None else counter.text(t) for t in texts]
            yield batch(schema, b.column("doc_id"), chars, tokens)

    return docs.select("doc_id", "text").mapInArrow(count, "doc_id long, n_chars long, n_tokens long")


@query()
def op1_token_counts(spark, sf_dir):
    """Tokens of every document."""
    return count_tokens(read_table(spark, sf_dir, "documents"))
