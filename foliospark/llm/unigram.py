"""Token counts under a unigram vocabulary: Viterbi that carries a score and a count only.

An Aho-Corasick automaton enumerates the pieces that end at each place of a
text; the best score up to there, and how many pieces it took, are all that is
carried on. Tie and unknown rules are those of the ``tokenizers`` library's
Unigram model: scores are summed from the left in double precision, of paths
with the same score that with the longest last piece wins, a character without
a piece of its own costs the lowest score less 10, and counts as its bytes
where the vocabulary has byte pieces; else a run of such characters is one
token.

A text is one path in general, as sums in double precision depend on what comes
before. Where the scores are whole numbers, whose sums are exact, and no piece
holds a space mark after another character, or a line break, the best path of a
text joins those of its chunks, and each distinct chunk is solved once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm import common

SPACE = "▁"
UNKNOWN = 10.0
REMEMBERED = 250_000


class Counter:
    """``vocabulary``: (piece, score) pairs; with one ``<0xHH>`` for each byte among them, unknown characters are bytes."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick

        pieces = {p for p, _ in vocabulary}
        self.bytes = all(f"<0x{b:02X}>" in pieces for b in range(256))
        exact = all(s == int(s) and abs(s) <= 1e9 for _, s in vocabulary)
        self.chunked = self.bytes and exact and not any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p in pieces)
        self.automaton = ahocorasick.Automaton()
        for p, s in vocabulary:
            if p:
                self.automaton.add_word(p, (len(p), float(s)))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN
        self.chunks = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
        self.memory: dict[str, int] = {}

    def solve(self, text: str) -> int:
        """Pieces in the best path of a text or chunk."""
        n = len(text)
        score, count, strange = [0.0] * (n + 1), [0] * (n + 1), bytearray(n + 1)  # strange: the path ends in an unknown character
        matches = self.automaton.iter(text)
        found = next(matches, None)
        for end in range(n):
            here = []
            while found is not None and found[0] == end:
                here.append(found[1])
                found = next(matches, None)
            best, pieces, single, odd = None, 0, False, 0
            for length, s in sorted(here, reverse=True):  # the longest, which starts first, first
                single |= length == 1
                total = s + score[end + 1 - length]
                if best is None or total > best:
                    best, pieces = total, count[end + 1 - length] + 1
            if not single and (best is None or self.unknown + score[end] > best):
                best, odd = self.unknown + score[end], 1
                pieces = count[end] + (len(text[end].encode("utf-8", "surrogatepass")) if self.bytes else not strange[end])
            score[end + 1], count[end + 1], strange[end + 1] = best, pieces, odd
        return count[n]

    def count(self, text: str) -> int:
        """Tokens of a text: a space mark before it, space marks for spaces."""
        if not text:
            return 0
        text = SPACE + text.replace(" ", SPACE)
        if not self.chunked:
            return self.solve(text)
        if len(self.memory) > REMEMBERED:
            self.memory.clear()
        known, total = self.memory, 0
        for chunk in self.chunks.findall(text):
            n = known.get(chunk)
            if n is None:
                n = self.solve(chunk)
                if len(chunk) <= 64:
                    known[chunk] = n
            total += n
        return total


def vocabulary(path: str) -> list[tuple[str, float]]:
    """The pieces of a sentencepiece model with their scores, taken as a unigram vocabulary.

    Control, unknown and byte pieces get the lowest score, so that no text is
    ever read as one of them by its spelling.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = lambda i: not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    return [(model.id_to_piece(i), model.get_score(i) if plain(i) else -1e9) for i in range(len(model))]


_COUNTERS: dict[str, Counter] = {}


def load(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(vocabulary(path))
    return _COUNTERS[path]


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(path)
        for batch in common.slices(batches, "text"):
            found = [counter.count(t or "") for t in common.column(batch, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays([common.column(batch, "doc_id"), pa.array(found, pa.int64())], names=["doc_id", "n_tokens"])

    return run


def token_counts(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens) for each row of ``docs``.

    Null and empty texts have no tokens. All rows stay, repeated ones too. Only
    ``doc_id`` and ``text`` are read. ``model`` is the place of the vocabulary
    file on every executor.
    """
    common.lean(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_count(model), "doc_id long, n_tokens long")
