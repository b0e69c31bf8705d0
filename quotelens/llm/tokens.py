"""Token ids of whole texts by a byte-level BPE file of the ``tokenizers`` library.

The pre-tokenizer never joins text across a white-space boundary but for one leading space, so a
text falls apart into units (a word with its leading space, punctuation after letters, or the rest
of a white-space run) that can be tokenized alone. Each distinct unit of a batch is tokenized once, and ids are
gathered back by position. Texts in which that rule could not hold (white space beyond ASCII,
the string of an added token) are tokenized whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np

from quotelens.llm.words import byte_table, per_process, units, utf8_buffer

#: Units remembered by a Python worker; beyond it the memory starts afresh.
REMEMBERED = 120_000
#: UTF-8 of white space beyond ASCII, and the information separators.
ODD = rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"


#: Fixed value: the pattern of the byte-level pre-tokenizer.
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.odd = re.compile(b"|".join([ODD, *(re.escape(t["content"].encode()) for t in spec.get("added_tokens", []))]))
        self.ranked = ranked_form(spec)
        self.known: dict[bytes, bytes] = {}

    def whole(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, np.uint32)

    def of_units(self, distinct: list[bytes]) -> list[bytes]:
        """Ids of each unit, as 32-bit numbers end to end."""
        known = self.known
        new = [u for u in distinct if u not in known]
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = distinct
        if self.ranked is not None:
            encode_one = self.ranked.encode_ordinary
            known.update((u, array("I", encode_one(u.decode("utf-8", "replace"))).tobytes()) for u in new)
        else:
            found = self.tokenizer.encode_batch_fast([u.decode("utf-8", "replace") for u in new], add_special_tokens=False)
            known.update((u, array("I", e.ids).tobytes()) for u, e in zip(new, found))
        return [known[u] for u in distinct]


def ranked_form(spec: dict):
    """The same vocabulary for ``tiktoken``, which takes short units several times faster; None if the file's
    merges don't come in the order of their ids or its pre-tokenizer is another one."""
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    vocab = model.get("vocab")
    if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec.get("normalizer") or model.get("type") != "BPE":
        return None
    if model.get("ignore_merges") or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
        return None
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocab.get(a + b, -1) for a, b in pairs]
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in the file
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    if any(x >= y for x, y in zip(made, made[1:])) or not all(c in byte_of for t in vocab if t not in special for c in t):
        return None
    ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in special}
    if any(bytes([b]) not in ranks for b in range(256)) or max(ranks[bytes([b])] for b in range(256)) > made[0]:
        return None
    import tiktoken
    return tiktoken.Encoding("ranked", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})


def encoder(path: str) -> Encoder:
    return per_process(("bpe", path), lambda: Encoder(path))


def unit_starts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where the units of all rows begin."""
    space = byte_table([0x20, *range(0x09, 0x0E)])[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    row_start, row_end = np.zeros(len(data), bool), np.zeros(len(data), bool)
    some = off[1:] > off[:-1]
    row_start[off[:-1][some]], row_end[off[1:][some] - 1] = True, True
    begin = row_start | (space & ~before) | (space & ~after & ~row_end)
    begin[1:] |= ~space[1:] & before[1:] & (data[:-1] != 0x20)
    # a run of ASCII letters ends at ASCII punctuation; only an apostrophe may go on with what follows
    letter = byte_table([*range(65, 91), *range(97, 123)])
    mark = byte_table(set(range(33, 127)) - {39, *range(48, 58), *range(65, 91), *range(97, 123)})
    begin[1:] |= mark[data[1:]] & letter[data[:-1]]
    return np.flatnonzero(begin)


def odd_rows(data: np.ndarray, off: np.ndarray, odd: re.Pattern) -> np.ndarray:
    """Rows that can't be cut into units."""
    found = [m.start() for m in odd.finditer(data.tobytes())]
    return np.unique(np.searchsorted(off, found, "right") - 1)


def encode(texts, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all rows end to end, row offsets) of a string array; nulls are empty."""
    enc = encoder(path)
    data, off = utf8_buffer(texts)
    if not len(data):
        return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
    begin = unit_starts(data, off)
    codes, distinct = units(data, np.diff(np.append(begin, len(data))))
    found = enc.of_units(distinct.to_pylist())
    size = np.fromiter(map(len, found), np.int32, len(found)) // 4
    flat = np.frombuffer(b"".join(found), np.uint32)
    at = (np.cumsum(size, dtype=np.int32) - size)[codes]
    n = size[codes]
    ends = np.cumsum(n, dtype=np.int32)
    ids = flat[np.repeat(at - (ends - n), n) + np.arange(ends[-1], dtype=np.int32)]
    rows = np.concatenate([[0], ends])[np.searchsorted(begin, off)]
    odd = odd_rows(data, off, enc.odd)
    if not len(odd):
        return ids, rows
    parts = [ids[a:b] for a, b in zip(rows[:-1], rows[1:])]
    for i in odd.tolist():
        parts[i] = enc.whole(data[off[i]:off[i + 1]].tobytes())
    return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
