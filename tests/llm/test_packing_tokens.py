import random
import struct
import zlib
from collections import defaultdict

import pyarrow as pa

from quotelens.llm.packing import best_fit_decreasing, pack_documents
from quotelens.llm.queries import tokenizer_file
from quotelens.llm.tokens import encode
from quotelens.llm.unigram import Counter, count_tokens, zipf_vocabulary
from tests.llm.cases import documents, frame

BPE = tokenizer_file("byte_bpe_50k.json")


def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(BPE)


def plain_best_fit(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in bins if r >= n]
        r = min(fits) if fits else capacity
        if fits:
            bins.remove(r)
        bins.append(r - n)
    return len(bins)


def test_rules_are_those_of_best_fit_decreasing():
    rng = random.Random(1)
    for capacity in (7, 64, 100):
        for _ in range(30):
            lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 200))] + [rng.randint(1, capacity)] * rng.randint(0, 40)
            counts = {n: lengths.count(n) for n in set(lengths)}
            fill, ranks = defaultdict(list), defaultdict(set)
            for n, rank, many, first, each, offset in best_fit_decreasing(counts, capacity).tolist():
                for j in range(many):
                    ranks[n].add(rank + j)
                    fill[first + j // each].append((offset + j % each * n, n))
            assert all(ranks[n] == set(range(c)) for n, c in counts.items())
            for spans in fill.values():
                at = 0
                for start, n in sorted(spans):
                    assert start == at
                    at += n
                assert at <= capacity
            assert len(fill) == plain_best_fit(lengths, capacity)


def test_units_give_the_tokenizers_ids():
    rng = random.Random(5)
    alphabet = ["a", "b'", "'s", "'ll", " ", "  ", "\n", "\t", "\r\n", "1", "23", "!", "?!", "é", "日本", " ", " ", "　", "\x1c", "\x85", "<|endoftext|>", "word", "😀"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 14))) for _ in range(3000)] + [None, ""]
    ids, off = encode(pa.array(texts), BPE)
    plain = tokenizer()
    for i, t in enumerate(texts):
        assert ids[off[i]:off[i + 1]].tolist() == plain.encode(t or "", add_special_tokens=False).ids, repr(t)


def test_pieces_are_whole_and_gapless(spark):
    rows = documents() + [(900, " ".join(["word"] * 2048), "en", "s"), (901, " ".join(["word"] * 2047), "en", "s"), (902, " ".join(["word"] * 5000), "en", "s")]
    got = pack_documents(frame(spark, rows), BPE).collect()
    plain, by_doc, by_sequence = tokenizer(), defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    total = 0
    for d, t, *_ in rows:
        if d == 212:  # repeated rows
            assert sum(r.piece == 0 for r in by_doc[212]) == 2
            total += sum(r.length for r in by_doc[212]) // 2
            continue
        ids, at = plain.encode(t or "", add_special_tokens=False).ids + [0], 0
        total += len(ids)
        pieces = sorted(by_doc[d], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(-(-len(ids) // 2048)))
        for r in pieces:
            assert r.start == at and (r.length == 2048 or r.piece == 0)
            assert zlib.crc32(struct.pack(f"<{r.length}I", *ids[at:at + r.length])) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    for spans in by_sequence.values():
        at = 0
        for start, n in sorted(spans):
            assert start == at
            at += n
        assert at <= 2048
    assert len(by_sequence) <= -(-total // 2048) + 1
    assert pack_documents(frame(spark, []), BPE).count() == 0


def unigram(vocabulary):
    from tokenizers import Tokenizer, models, pre_tokenizers
    out = Tokenizer(models.Unigram([("<unk>", 0.0), *vocabulary], unk_id=0))
    out.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return out


def test_counts_equal_the_library(spark):
    vocabulary = zipf_vocabulary(tokenizer_file("piece_bpe_32k.model"))
    plain, rows = unigram(vocabulary), documents()
    got = sorted(((r.doc_id is None, r.doc_id, r.n_tokens) for r in count_tokens(frame(spark, rows), vocabulary).collect()), key=str)
    assert got == sorted(((d is None, d, len(plain.encode(t or "", add_special_tokens=False).ids)) for d, t, *_ in rows), key=str)
    assert count_tokens(frame(spark, []), vocabulary).count() == 0


def test_ties_and_unknown_characters():
    """Equal path scores: the longer first piece wins, as in the library; neighbouring unknowns are one."""
    vocabulary = [("a", -1.0), ("b", -1.0), ("ab", -2.0), ("abc", -3.0), ("bc", -2.0), ("c", -1.0), ("▁", -1.5), ("▁a", -2.5), ("cab", -3.0), ("d", -7.0)]
    plain, mine, rng = unigram(vocabulary), Counter(vocabulary), random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choices("abcdxy ▁", k=rng.randint(1, 12)))
        begin = [0, *(i for i, c in enumerate(text) if c == " " and i)]
        got = sum(mine.unit(text[i:j].encode()) if i == 0 or text[i] == " " else 0 for i, j in zip(begin, [*begin[1:], len(text)]))
        assert got == len(plain.encode(text, add_special_tokens=False).ids), repr(text)
