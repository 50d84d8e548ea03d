"""Token counts by count-only Viterbi over a unigram vocabulary."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from salvor.llm.common import arrow, batches, by_batches, table

UNKNOWN_PENALTY = 10.0
KEPT_UNITS = 400_000
UNIT = re.compile(" *[^ ]+| +")


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece file in id order, read as a unigram vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class UnitCounter(dict):
    """unit -> (pieces, score). A unit is a run of spaces and the word after it: no piece has a space
    sign after another character, so the best path of a text is that of its units, one by one."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick

        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece.replace("▁", " "), (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p.replace("▁", " ") for p, _ in vocabulary if len(p) == 1}
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY

    def viterbi(self, unit: str) -> tuple[int, float]:
        """Best score and its piece count. Matches that end at one place come from the longest on,
        which is the order of their starts; only a strictly better score replaces, as in the
        tokenizer. A character that is no piece costs the penalty and counts its UTF-8 bytes."""
        size = len(unit)
        best, count = [0.0] + [None] * size, [0] * (size + 1)
        found: dict[int, list[tuple[int, float]]] = {}
        for end, match in self.automaton.iter(unit):
            found.setdefault(end, []).append(match)
        for end in range(size):
            top, pieces = None, 0
            for length, score in found.get(end, ()):
                start = end + 1 - length
                if top is None or best[start] + score > top:
                    top, pieces = best[start] + score, count[start] + 1
            if unit[end] not in self.single and (top is None or best[end] + self.unknown > top):
                top, pieces = best[end] + self.unknown, count[end] + len(unit[end].encode("utf-8", "surrogatepass"))
            best[end + 1], count[end + 1] = top, pieces
        return count[size], best[size]

    def __missing__(self, unit: str) -> tuple[int, float]:
        counted = self.viterbi(unit)
        if len(unit) <= 64:
            if len(self) >= KEPT_UNITS:
                self.clear()
            self[unit] = counted
        return counted

    def text(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        counted = [self[u] for u in UNIT.findall(" " + text.replace("▁", " "))]
        return sum(c for c, _ in counted), sum(s for _, s in counted)


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and the best path's score, for every row; nothing is shuffled.

    The tokenizer is the unigram model over the vocabulary of ``path``: a space sign goes before
    the text, spaces are that sign, unknown characters fall back to bytes. Scores are added
    as whole numbers in doubles, so cutting at words loses no tie.
    Null and empty texts have 0 tokens. Repeated rows give repeated results, an empty table none.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("score", pa.float64())])

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = UnitCounter(read_vocabulary(path))
        for batch, texts in batches(source):
            counted = [counter.text(t) for t in texts]
            yield arrow(schema, [batch.column("doc_id").to_pylist(), [c for c, _ in counted], [s for _, s in counted]])

    return by_batches(docs.selectExpr("cast(doc_id as bigint) doc_id", "text"), count, "doc_id long, n_tokens long, score double")


def query(spark, folder: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
