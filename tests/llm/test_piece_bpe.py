import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from conftest import thue_morse

from strata.llm import flat, piece_bpe

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def pieces():
    with open(PATH, "rb") as f:
        return piece_bpe.PieceTable(f.read())


def texts():
    r = random.Random(1)
    letters = " abAB01.,\n\t▁éß漢字かな😀‍́\x00ทй-_(){}=/\\"
    out = ["", " ", "  ", "\n", "▁", "▁▁ x", "a", "<s>", "</s> <unk> <0x41>", "é" * 10, " lead", "trail ", "a  b"]
    out += ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(1500)]
    out += ["".join(chr(r.choice([r.randrange(32, 0x250), r.randrange(0x4E00, 0x5000), r.randrange(0x1F300, 0x1F600), r.randrange(0, 0xD7FF)])) for _ in range(30)) for _ in range(800)]
    # Long words: no blanks, one run; two of equal polynomial hashes.
    return out + [*thue_morse(), "the" * 5000 + "ing" * 3000, "".join(r.choice("ethnsai") for _ in range(20_000)), "ab" * 3000 + "the" * 2000, "a" * 7000, "   " * 3000 + "x", "".join(r.choice("abcdefghijklmnop") for _ in range(9000))]


def test_ids_and_decoding_equal_the_library(pieces, library):
    all_texts = texts()
    for first, raw, off in flat.text_chunks(pa.array(all_texts), 40_000):
        ids, at = piece_bpe.encode_chunk(pieces, raw, off)
        decoded = piece_bpe.decode_chunk(pieces, ids, at)
        for i in range(len(off) - 1):
            want = library.encode(all_texts[first + i])
            assert ids[at[i] : at[i + 1]].tolist() == want
            assert decoded[i] == library.decode(want)


def test_table_nulls_repeats_and_clashes(documents, library):
    rows = [(1, None), (2, ""), (3, "Hello  world\n"), (3, "Hello  world\n"), (None, "x"), (4, "ab " * 50_000)]
    df = documents(*[(d, t, "l", "s", 1, "i", "q") for d, t in rows], extra=", ids string, decoded string")
    got = piece_bpe.encode_decode(df, PATH)
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    want = sorted((str(d), library.encode(t or "", add_bos=True, add_eos=True), t or "") for d, t in rows)
    assert sorted((str(r["doc_id"]), list(r["ids"]), r["decoded"]) for r in got.collect()) == want
    packed = {r["doc_id"]: bytes(r["ids"]) for r in piece_bpe.encode_decode(df, PATH, packed=True).collect()}
    assert packed[3] == b"".join(i.to_bytes(4, "little") for i in library.encode("Hello  world\n", add_bos=True, add_eos=True))
    assert piece_bpe.encode_decode(df.limit(0), PATH).count() == 0
