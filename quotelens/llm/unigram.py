"""Token counts of a unigram tokenizer without building tokens.

Texts are cut before each space, as a Metaspace pre-tokenizer does, and each distinct unit of a
batch is segmented once. An Aho-Corasick automaton of the vocabulary lists every piece that ends
at each character; dynamic programming carries the best score and the number of pieces of that
best path. Ties follow the ``tokenizers`` library: starts are tried from left to right and only
a strictly better score replaces an earlier one; a character that is no piece by itself costs the
worst score less 10, and neighbouring unknown characters are one piece.

Defined results: null and empty texts have no tokens; every row is counted, whole. Other columns
are ignored.
"""

from __future__ import annotations

import math
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelens.llm.hyperminhash import slices
from quotelens.llm.words import per_process, units, utf8_buffer

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Units remembered by a Python worker; beyond it the memory turns: what is met again before the next turn stays.
REMEMBERED = 600_000


def zipf_vocabulary(model_path: str) -> list[tuple[str, float]]:
    """Ordinary pieces of a sentencepiece file; the r-th has the log probability of Zipf's law, -ln(r H)."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    total = sum(1 / r for r in range(1, len(pieces) + 1))
    return [(p, -math.log(r * total)) for r, p in enumerate(pieces, 1)]


class Counter:
    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        for piece, score in dict(vocabulary).items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.known: dict[bytes, int] = {}
        self.old: dict[bytes, int] = {}

    def pieces(self, text: str) -> int:
        """Pieces of the best path through one unit."""
        n, worst = len(text), self.unknown
        score, count, unknown = [0.0], [0], [False]  # at the end of each character
        at, best, start, single = 0, -math.inf, 0, False  # of the character whose matches are being read
        for end, (length, value) in chain(self.automaton.iter(text), ((n, (0, 0.0)),)):  # of one end the longest first
            while at < end:
                if single or worst + score[at] <= best:
                    score.append(best)
                    count.append(count[start] + 1)
                    unknown.append(False)
                else:
                    score.append(worst + score[at])
                    count.append(count[at] + (not unknown[at]))
                    unknown.append(True)
                at, best, single = at + 1, -math.inf, False
            if length:
                found = value + score[end + 1 - length]
                if found > best:
                    best, start = found, end + 1 - length
                if length == 1:
                    single = True
        return count[n]

    def unit(self, raw: bytes) -> int:
        found = self.known.get(raw)
        if found is None and raw in self.old:
            found = self.known[raw] = self.old[raw]
        if found is None:
            text = raw.decode("utf-8", "replace").replace(" ", SPACE)
            if not text.startswith(SPACE):
                text = SPACE + text
            found = self.known[raw] = sum(self.pieces(SPACE + part) for part in text.split(SPACE)[1:])
        return found


def count_function(vocabulary):
    def count(batches):
        counter = per_process(("unigram", hash(tuple(vocabulary.value))), lambda: Counter(vocabulary.value))
        for whole in batches:
            for batch in slices(whole, "text"):
                data, off = utf8_buffer(batch.column("text"))
                total = np.zeros(batch.num_rows, np.int64)
                if len(data):
                    if len(counter.known) > REMEMBERED:
                        counter.known, counter.old = {}, counter.known
                    begin = data == 0x20
                    begin[off[:-1][off[1:] > off[:-1]]] = True
                    begin = np.flatnonzero(begin)
                    codes, distinct = units(data, np.diff(np.append(begin, len(data))))
                    size = np.array([counter.unit(u) for u in distinct.to_pylist()], np.int64)
                    total = np.diff(np.concatenate([[0], np.cumsum(size[codes])])[np.searchsorted(begin, off)])
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(total)], names=["id", "n_tokens"])
    return count


def count_tokens(docs: DataFrame, vocabulary: list[tuple[str, float]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens of every row. The vocabulary (pieces and scores, a parameter of fixed size) is broadcast."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    return base.mapInArrow(count_function(shared), f"id {kind}, n_tokens long").withColumnRenamed("id", id_col)
