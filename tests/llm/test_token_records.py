import json
import os
import random
import struct
import zlib
from pathlib import Path

import numpy as np
import pytest

from stratum.llm import token_records as R
from stratum.llm.checksums import crc32c, masked

from .common import documents, edge_cases


def plain_crc(raw: bytes) -> int:
    value = 0xFFFFFFFF
    for b in raw:
        value ^= b
        for _ in range(8):
            value = (value >> 1) ^ (0x82F63B78 if value & 1 else 0)
    return value ^ 0xFFFFFFFF


def plain_masked(raw: bytes) -> int:
    c = plain_crc(raw)
    return (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def test_checksums():
    assert plain_crc(b"123456789") == 0xE3069283
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 60_000, dtype=np.uint8)
    sizes = np.array([0, 1, 2, 3, 4, 5, 63, 64, 65, 128, 129, 191, 192, 193, 64 * 33, 64 * 32 + 1, 9, *rng.integers(0, 1500, 20)])
    starts = np.cumsum(sizes) - sizes
    got = crc32c(data, starts, sizes)
    want = [plain_crc(data[a : a + n].tobytes()) for a, n in zip(starts, sizes, strict=True)]
    assert got.tolist() == want
    assert masked(got)[5] == plain_masked(data[starts[5] : starts[5] + 5].tobytes())
    assert crc32c(data, np.zeros(0), np.zeros(0)).tolist() == []


def plain_records(raw: bytes) -> list[tuple]:
    """(doc_id, ids) of a record file, read byte by byte."""
    out, at = [], 0
    while at < len(raw):
        (length,), (check,) = struct.unpack_from("<Q", raw, at), struct.unpack_from("<I", raw, at + 8)
        assert check == plain_masked(raw[at : at + 8])
        payload = raw[at + 12 : at + 12 + length]
        assert struct.unpack_from("<I", raw, at + 12 + length)[0] == plain_masked(payload)
        doc_id, flags, width = struct.unpack_from("<qII", payload)
        out.append((None if flags else doc_id, list(np.frombuffer(payload[16:], f"<u{width}"))))
        at += 16 + length
    return out


@pytest.mark.parametrize("width", [2, 4])
def test_frames_are_read_back_by_a_plain_reader(width):
    ids, bounds = np.array([5, 6, 7, 1, 1, 65_535], dtype=np.uint32), np.array([0, 4, 5, 5, 6])
    data, lengths = R.frame(np.array([3, -4, 0, 2**40]), np.array([False, False, True, False]), ids, bounds, width)
    assert plain_records(data.tobytes()) == [(3, [5, 6, 7, 1]), (-4, [1]), (None, []), (2**40, [65_535])]
    doc_ids, missing, back, offsets = R.unframe(data, lengths)
    assert back.tolist() == ids.tolist() and offsets.tolist() == bounds.tolist() and missing.tolist() == [False, False, True, False]
    for place in (0, 9, 13, len(data) - 1):
        bad = data.copy()
        bad[place] ^= 1
        with pytest.raises(R.Damaged):
            R.unframe(bad, lengths)


def tokenizer() -> str | None:
    try:
        path = R.public_tokenizer()
    except ImportError:
        return None
    return path if os.path.exists(path) else None


needs_tokenizer = pytest.mark.skipif(not tokenizer(), reason="no tokenizer")
ODD = [(30, "A <|endoftext|>b<|startoftext|> c"), (31, "é ́x Ångström  ΣΣ  y\x85z w"), (32, "don't  I'LL\r\n\x0b\x0cwe'd 123,4"), (33, "\x00\x1c\x1f a​b"), (34, "漢字" * 40 + " x" * 9), (-7, "negative id")]


def plain_ids(rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer())
    return [(i, [*t.encode(text or "", add_special_tokens=False).ids, 1]) for i, text in rows]


@needs_tokenizer
def test_words_encoded_once_give_the_ids_of_whole_texts(monkeypatch):
    import pyarrow as pa

    from stratum.llm.textarrays import text_blocks

    spec = Path(tokenizer()).read_text(encoding="utf-8")
    monkeypatch.setattr(R, "JOINED_WORDS", 7)
    monkeypatch.setattr(R, "CACHE_WORDS", 500)
    encoder = R.Encoder(spec)
    assert encoder.by_word and encoder.by_sign and encoder.ends.sum() > 1000
    rng = random.Random(4)
    alphabet = ["a", "B", "é", "é", "́", " ", " ", "\n", "\t", "\x0b", "'", "s", "1", "²", "ß", "İ", " ", "‍", "漢", "\U0001f600", "<|endoftext|>", "<", "|", "\x85", "Σ", ".", "§", "-", ",", "...", "it's", "word", "Wört", "…", ">", "_"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 30))) for _ in range(3000)] + [t for _, t in ODD]
    for first, end, data, offsets in text_blocks(pa.array(texts)):
        ids, bounds = encoder.block(data, offsets)
        want = [e.ids for e in encoder.tokenizer.encode_batch(texts[first:end], add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == want


@needs_tokenizer
def test_other_tokenizers_get_whole_texts():
    spec = json.loads(Path(tokenizer()).read_text(encoding="utf-8"))
    assert R.splits_at_spaces(spec)
    assert not R.splits_at_spaces(spec | {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True, "trim_offsets": True}})
    assert not R.splits_at_spaces(spec | {"pre_tokenizer": None})
    assert not R.splits_at_spaces(spec | {"added_tokens": [spec["added_tokens"][0] | {"lstrip": True}]})
    assert not R.splits_at_spaces(spec | {"normalizer": {"type": "Prepend", "prepend": "x"}})


def files_of(folder: str, manifest) -> list[list[tuple]]:
    return [plain_records(Path(folder, f"{f.name}.rec").read_bytes()) for f in manifest.files]


@needs_tokenizer
@pytest.mark.parametrize("file_bytes", [200, 1 << 20])
def test_files_and_what_is_read_from_them(spark, tmp_path, file_bytes):
    rows = [*(r for r in edge_cases() if r[0] != 7), *ODD, (40, "x y " * 3000)]
    folder = "file://" + str(tmp_path / "set")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2" if file_bytes == 200 else "10000")  # a task's batches, after which a file may end
    try:
        manifest = R.write_token_records(documents(spark, rows), folder, file_bytes=file_bytes)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert manifest.width == 2 and R.read_manifest(spark, folder) == manifest
    in_files = files_of(str(tmp_path / "set"), manifest)
    written = [r for f in in_files for r in f]
    want = plain_ids(rows)
    order = lambda i: -(10**9) if i is None else i
    assert [i for i, _ in written] == sorted((i for i, _ in rows), key=order)
    assert sorted(written, key=str) == sorted(((i, x) for i, x in want), key=str)
    assert [(f.records, f.tokens) for f in manifest.files] == [(len(f), sum(len(x) for _, x in f)) for f in in_files]
    if file_bytes == 200:
        assert len(manifest.files) > 2

    got = sorted(R.read_token_records(spark, folder, ("file", "record", "doc_id", "start", "n_tokens", "ids", "ids_crc32")).collect())
    assert [(r.doc_id, r.ids) for r in got] == written
    assert [r.start for r in got] == np.cumsum([0, *(len(x) for _, x in written)])[:-1].tolist()
    assert [r.ids_crc32 for r in got] == [zlib.crc32(np.array(x, "<u4").tobytes()) for _, x in written]

    one, again, other = (R.shuffled_token_records(spark, folder, seed, partitions=3).collect() for seed in (1, 1, 2))
    assert one == again and [r.doc_id for r in one] != [r.doc_id for r in other]
    assert sorted(one, key=lambda r: (r.file, r.record)) == [type(one[0])(**{k: r[k] for k in one[0].asDict()}) for r in got]


@needs_tokenizer
def test_damage_is_found(spark, tmp_path):
    folder = str(tmp_path / "set")
    manifest = R.write_token_records(documents(spark, [(1, "one two"), (2, "three")]), "file://" + folder)
    path = Path(folder, manifest.files[0].name + ".rec")
    raw = bytearray(path.read_bytes())
    raw[-5] ^= 1
    path.write_bytes(raw)
    with pytest.raises(Exception, match="checksum of a record"):
        R.read_token_records(spark, "file://" + folder).collect()
    index = Path(folder, manifest.files[0].name + ".idx")
    index.write_bytes(index.read_bytes()[:-1])
    with pytest.raises(Exception, match="size of the index"):
        R.read_index(spark, "file://" + folder).collect()


@needs_tokenizer
def test_files_of_failed_attempts_go_and_empty_tables_have_none(spark, tmp_path):
    folder = tmp_path / "set"
    folder.mkdir()
    (folder / "part-000000-0000-dead.rec").write_bytes(b"half")
    manifest = R.write_token_records(documents(spark, []), "file://" + str(folder))
    assert manifest.files == () and [p.name for p in folder.iterdir() if p.name.startswith("part-")] == []
    assert R.read_token_records(spark, "file://" + str(folder)).isEmpty() and R.read_index(spark, "file://" + str(folder)).isEmpty()
    assert R.shuffled_token_records(spark, "file://" + str(folder), 1).isEmpty()
    with pytest.raises(LookupError):
        R.read_token_records(spark, "file://" + str(tmp_path / "none"))


def test_ranges_of_one_hash_are_told_apart(monkeypatch):
    from stratum.llm import textarrays as A

    data = np.frombuffer(b"abcabxabc", dtype=np.uint8)
    starts, ends = np.array([0, 3, 6]), np.array([3, 6, 9])
    example, inverse = A.distinct_ranges(data, starts, ends)
    assert inverse[0] == inverse[2] != inverse[1]
    monkeypatch.setattr(A, "token_hashes", lambda data, a, b, lower: np.zeros(len(a), dtype=np.uint64))
    example, inverse = A.distinct_ranges(data, starts, ends)
    assert inverse.tolist() == [0, 1, 0] and example.tolist() == [0, 1]
    assert A.distinct_ranges(data, starts, ends, np.array([0, 0, 1]))[1].tolist() == [0, 1, 2]


@needs_tokenizer
def test_a_text_larger_than_a_block_and_shared_ids(spark, tmp_path):
    rng = random.Random(8)
    long = " ".join(f"word{rng.randrange(5000)}" for _ in range(900_000))
    rows = [(5, long), (5, "short"), (5, "short"), (None, None), (None, "b")]
    folder = "file://" + str(tmp_path / "set")
    R.write_token_records(documents(spark, rows), folder)
    got = sorted((r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in R.read_token_records(spark, folder, ("doc_id", "n_tokens", "ids_crc32")).collect())
    assert got == sorted((i or 0, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in plain_ids(rows))
