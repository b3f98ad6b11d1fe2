"""Encoding, counts, files and packing against the library itself."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")

from tokenizers import Tokenizer  # noqa: E402

from aerofuse.llm import packing, pfor  # noqa: E402
from aerofuse.llm.token_counts import count_spliced, count_tokens  # noqa: E402
from aerofuse.llm.tokens import Encoder  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = Encoder(PATH, memo_units=50)
PARTS = st.sampled_from(["a", "word", "Ünï", "漢", " ", "  ", "\n", "\t", ".", ",", "'s", "12", "²", "<|endoftext|>", "\xa0", "\x1c", "́", "😀"])


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=12).map("".join), max_size=4))
def test_units_give_the_ids_of_whole_texts(texts):
    found, counts = OWN.encode([*texts, None])
    assert [found[e - n : e].tolist() for e, n in zip(np.cumsum(counts), counts, strict=True)] == [ids(t) for t in [*texts, None]]


def test_texts_with_blanks_that_meet_are_cut_as_well():
    text = " lead  in\r\n" + "one two,  three\n\nfour. five\t\tsix\n" * 300 + "\t end "
    own = Encoder(PATH)
    found, counts = own.encode(["", text, "\t", "\n", " ", None, "plain text\nof two lines", text])
    assert found.tolist() == [i for t in ("", text, "\t", "\n", " ", "", "plain text\nof two lines", text) for i in ids(t)]
    assert counts[1] == len(ids(text))
    assert max(map(len, own.known)) < 25  # no unit is a whole text


@settings(max_examples=150, deadline=None)
@given(st.lists(PARTS, min_size=30, max_size=200).map("".join), st.integers(4, 40), st.integers(1, 9))
def test_spliced_counts(text, chunk, overlap):
    assert count_spliced(LIBRARY, text, chunk, overlap) == len(ids(text))


def test_counts_of_awkward_texts(awkward, awkward_rows, nothing):
    rows = count_tokens(awkward, PATH).collect()
    expected = [(r[0], len((r[1] or "").encode()), len(ids(r[1])), len(ids(r[1])) > 1024) for r in awkward_rows]
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)
    assert count_tokens(nothing, PATH).count() == 0


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "word_bpe_49k.json"])
def test_other_tokenizers(awkward, awkward_rows, name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path).encode
    else:
        other = Tokenizer.from_file(path)
        library = lambda t: other.encode(t, add_special_tokens=False).ids
    found = sorted((r["n_bytes"], r["n_tokens"]) for r in count_tokens(awkward, path).collect())
    assert found == sorted((len((r[1] or "").encode()), len(library(r[1] or ""))) for r in awkward_rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=3000), st.data())
def test_blocks_round_trip(values, data):
    array = np.array(values, np.uint32)
    file = pfor.File(pfor.encode(array, [None, 7], np.array([len(array), 0])))
    a = data.draw(st.integers(0, len(array)))
    b = data.draw(st.integers(a, len(array)))
    assert (file.ids(a, b) == array[a:b]).all()
    assert file.doc_ids == [None, 7]


def test_small_numbers_take_few_bits():
    rng = np.random.default_rng(1)
    small = rng.integers(1000, 1064, 102_400).astype(np.uint32)
    small[::100] = 50_000  # outliers go to the exception lists
    assert len(pfor.encode(small, [1], np.array([len(small)]))) < 1.05 * len(small)


@pytest.mark.parametrize("file_ids", [50, 4_000_000])
def test_files_read_back(spark, awkward, awkward_rows, many_shards, file_ids):
    folder = pfor.new_folder(spark)
    rows = pfor.read_documents(spark, pfor.write_ids(awkward, PATH, folder, file_ids=file_ids), folder).collect()
    found = sorted((r["start"], r["n_tokens"], r["ids_crc32"], r["doc_id"]) for r in rows)
    at = 0
    for start, n, _, _ in found:
        assert start == at
        at += n
    keys = [(-1 if d is None else d) for *_, d in found]
    assert keys == sorted(keys)
    expected = [(len(x), zlib.crc32(np.array(x, "<u4").tobytes()), r[0]) for r in awkward_rows for x in [ids(r[1]) + [0]]]
    assert sorted((f[1:] for f in found), key=str) == sorted(expected, key=str)


def test_no_files_of_an_empty_table(spark, nothing):
    folder = pfor.new_folder(spark)
    files = pfor.write_ids(nothing, PATH, folder)
    assert files.count() == 0


def check_packed(rows, texts):
    """Every id in one piece; sequences without gaps, full or a power of two long."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r["length"] > 0
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, text in texts.items():
        whole, at = ids(text) + [1], 0
        for start, n, crc, total in sorted(pieces[doc]):
            assert start == at and total == len(whole)
            assert crc == zlib.crc32(np.array(whole[start : start + n], "<u4").tobytes())
            at += n
        assert at == len(whole)
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == 2048 or at & (at - 1) == 0
    return sequences


@pytest.mark.parametrize("shard_ids", [500, 2_000_000])
def test_packing_is_whole(awkward, awkward_rows, nothing, many_shards, shard_ids):
    once = awkward.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"])
    check_packed(packing.packed(once, PATH, shard_ids=shard_ids).collect(), {r[0]: r[1] for r in awkward_rows if r[0] is not None})
    total = sum(len(ids(r[1])) + 1 for r in awkward_rows)
    assert packing.packed(awkward, PATH, shard_ids=shard_ids).groupBy().sum("length").first()[0] == total
    assert packing.packed(nothing, PATH).count() == 0


def test_neighbours_fill_the_window():
    texts = [np.arange(10) + 100 * (k % 2) for k in range(8)]
    idf = np.ones(400, np.float32)
    pieces = packing.pack([t.astype(np.uint16) for t in texts], idf, 10.0, window=40)
    by_sequence = defaultdict(set)
    for k, _, _, sequence, _ in pieces:
        by_sequence[sequence].add(k % 2)
    assert all(len(kinds) == 1 for kinds in by_sequence.values())  # each window holds texts of one kind
