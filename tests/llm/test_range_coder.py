import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from granary.llm import range_coder
from granary.llm.range_coder import BlockError, decode_blocks, encode_blocks, opened, read_documents, sealed, write_ids, written_and_read
from granary.session import new_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize(("planes", "high"), [(2, 1 << 16), (4, 1 << 32)])
def test_round_trip_of_any_ids(planes, high):
    draw = np.random.default_rng(planes)
    blocks = [draw.integers(0, high if k % 3 else 4, draw.integers(1, 900)) for k in range(60)]
    blocks += [np.zeros(900, np.int64), np.array([high - 1]), np.full(700, high - 1), np.tile(np.arange(7), 100)]
    codes = encode_blocks(blocks, planes)
    for a, b in zip(blocks, decode_blocks(codes, [len(b) for b in blocks], planes), strict=True):
        assert (a == b).all()
    # A block does not depend on its neighbours.
    alone = encode_blocks([blocks[5]], planes)[0]
    assert (alone == codes[5]).all() and (decode_blocks([codes[5]], [len(blocks[5])], planes)[0] == blocks[5]).all()


def test_repeated_ids_take_few_bits():
    draw = np.random.default_rng(1)
    text = np.tile(draw.integers(0, 40_000, 60), 60)
    noise = draw.integers(0, 40_000, 3600)
    code = encode_blocks([text, noise], 2)
    assert 16 * len(code[0]) < 2.5 * len(text) and 16 * len(code[1]) < 18 * len(noise)


def test_damage_is_found():
    entries = np.array([(5, 0, 0, 0, 4)], range_coder._ENTRY)
    block = sealed(entries, 4, 2, encode_blocks([np.array([1, 2, 3, 4])], 2)[0], 17)
    assert opened(block)[4] == 17
    for place in range(len(block)):
        with pytest.raises(BlockError):
            opened(block[:place] + bytes([block[place] ^ 4]) + block[place + 1 :])
    with pytest.raises(BlockError):
        opened(block[:10])


def expected(rows):
    library = Tokenizer.from_file(PATH)
    return [(r.doc_id, np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 1], np.uint32)) for r in rows]


def test_awkward_documents(spark, awkward):
    target = new_path(spark, "ids")
    write_ids(awkward, PATH, target)
    assert spark.read.parquet(target).columns == ["file", "block", "data"]
    found = read_documents(spark, target)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = sorted(found.collect(), key=lambda r: r.start)
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    want = sorted((str(i), len(x), zlib.crc32(x.tobytes())) for i, x in expected(awkward.collect()))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in rows) == want


def test_nothing(nothing):
    assert written_and_read(nothing, PATH).count() == 0


def test_a_section_holds_the_frequencies_of_its_ids():
    draw = np.random.default_rng(3)
    share = 1 / np.arange(1, 3001)
    blocks = [draw.choice(3000, n, p=share / share.sum()).astype(np.uint32) * 13 for n in (2048, 2048, 700, 1)]
    order0 = range_coder.frequencies(np.concatenate(blocks), 2)
    codes = encode_blocks(blocks, 2, order0)
    # The entropy of one id is 8.5 bits; with ids that are no hit coded as bytes it took 12.3.
    assert 16 * sum(map(len, codes[:2])) < 8.6 * 4096
    whole = [sealed(np.array([(k, k, 0, 0, len(b))], range_coder._ENTRY), len(b), 2, c, 0) for k, (b, c) in enumerate(zip(blocks, codes, strict=True))]
    data = range_coder.section(whole, 2, order0)
    found, parts = range_coder.section_parts(data)
    assert parts == whole and all((a == b).all() for a, b in zip(found, order0, strict=True))
    for a, b in zip(decode_blocks([opened(p)[3] for p in parts], [len(b) for b in blocks], 2, found), blocks, strict=True):
        assert (a == b).all()
    for place in [*range(0, len(data) - sum(map(len, whole)), 7), len(data) - 1]:
        with pytest.raises(BlockError):
            for part in range_coder.section_parts(data[:place] + bytes([data[place] ^ 4]) + data[place + 1 :])[1]:
                opened(part)


def test_frequencies_of_one_id_and_of_all_ids():
    for ids in (np.full(500, 7, np.uint32), np.arange(1 << 16, dtype=np.uint32), np.array([0, 0xFFFFFFFF] * 300, np.uint32)):
        for planes in (2, 4) if ids.max() < 1 << 16 else (4,):
            order0 = range_coder.frequencies(ids, planes)
            blocks = [ids[a : a + 2048] for a in range(0, len(ids), 2048)]
            for a, b in zip(decode_blocks(encode_blocks(blocks, planes, order0), [len(b) for b in blocks], planes, order0), blocks, strict=True):
                assert (a == b).all()
