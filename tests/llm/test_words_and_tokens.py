import random
import re
from functools import reduce

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from granary.llm.token_counts import chunk_map, composed, token_counts, total
from granary.llm.tokens import encoder
from granary.llm.transducer import transducer
from granary.llm.words import Words, utf8_buffers

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
BITS = ["a", "B", "é", "É", " ", "  ", "\n", "\t", "'s", "'LL", "'ll", "'", "!'", "<|endoftext|>", "1", "23", "²", "!", "…", "\xa0", "ß", "İ", "́", "Σ", "日本", " 's", "\x1c", " ", "🙂", "Ÿ", "ŉ", "ﬁ", "é", "Å", "\x85", "µ", "don't", "the", "tion"]


def strings(n, seed=1):
    pick = random.Random(seed)
    return ["".join(pick.choice(BITS) for _ in range(pick.randint(0, 14))) for _ in range(n)]


def test_words_are_those_of_the_pattern():
    texts = [None, "", "  a b\tc ", "Hello  WORLD", "a", "é ñ\x0bA", *strings(300)]
    found = Words(*utf8_buffers(pa.array(texts)))
    for k, text in enumerate(texts):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        assert [found.text(i, i + 1) for i in range(found.first[k], found.first[k + 1])] == re.findall(r"[^\x20\x09-\x0D]+", lower)
    same = {}
    for k in range(len(found.start)):
        assert same.setdefault(found.text(k, k + 1), found.hash[k]) == found.hash[k]
    assert len(set(same.values())) == len(same)


@pytest.mark.parametrize("name", FILES)
def test_ids_are_the_library_s(name):
    path = public_tokenizers.path(name)
    library = Tokenizer.from_file(path)
    texts = strings(6000)
    found = encoder(path).encode(texts)
    for text, ids, ref in zip(texts, found, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(ids, np.uint32).tolist() == ref.ids, repr(text)
    assert transducer(path).counts(texts).tolist() == [len(i) // 4 for i in found]


def test_a_new_table_goes_on_where_the_old_one_was_full(monkeypatch):
    import granary.llm.transducer as module

    path = public_tokenizers.path("byte_bpe_50k.json")
    machine = module.Transducer(path)
    monkeypatch.setattr(module, "STATES", 40)
    texts = strings(300, 5)
    want = [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [int(machine.counts([t])[0]) for t in texts] == want


def test_chunk_maps_compose_in_any_order():
    machine = transducer(public_tokenizers.path("byte_bpe_50k.json"))
    pick = random.Random(3)
    for text in strings(400, 7):
        cuts = sorted({0, len(text), *(pick.randint(0, len(text)) for _ in range(3))})
        maps = [chunk_map(text[a:b], machine) for a, b in zip(cuts, cuts[1:], strict=False)] or [chunk_map(text, machine)]
        want = len(machine.library.encode(text, add_special_tokens=False).ids)
        assert total(reduce(lambda a, b: composed(a, b, machine), maps), machine) == want
        assert total(reduce(lambda b, a: composed(a, b, machine), reversed(maps)), machine) == want


@pytest.mark.parametrize("chunk", [1 << 14, 100, 7])
def test_counts_of_a_table(awkward, chunk):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    found = token_counts(awkward, path, chunk=chunk)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = []
    for row in awkward.collect():
        n = len(library.encode(row.text or "", add_special_tokens=False).ids)
        want.append((row.doc_id, len((row.text or "").encode()), n, n > 512))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)


def test_counts_of_nothing(nothing):
    assert token_counts(nothing, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
