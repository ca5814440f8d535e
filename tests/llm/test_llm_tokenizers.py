"""Alignment and byte-level BPE against the tokenizer libraries and brute force."""

import base64
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import tiktoken
from llm_helpers import awkward, documents

from ledgermatch.llm import alignment, byte_bpe, queries

SF0001 = "/root/testdata/sf0.001"
PARTS = ["'", "'ll", "'re", "l", " ", "  ", "\n", "\t", "a", "word", "Étion", "12", "٣", "!", "?!", "՘", "\U00018d10", "\U0001f600",
         "กำ", "é", "x" * 30, "9" * 25, " " * 20, "<|endoftext|>", "<s>", "日本語", "\x85", " ", "▁", "ﬁ", "it's", "I'LL",
         "\x00", "the and of "]


def mixed(seed, n, most):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(most))) for _ in range(n)]


# ---- 13 byte-level BPE ----------------------------------------------------

@pytest.fixture(scope="module")
def library():
    with open(byte_bpe.RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=byte_bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(row):
    return np.frombuffer(bytes(row.ids), "<u4").tolist()


@pytest.mark.parametrize("chunk,overlap", [(1 << 15, 1 << 9), (40, 8), (7, 4)])
def test_ids_equal_the_library_and_decode_to_the_text(spark, library, chunk, overlap):
    texts = mixed(1, 150, 80) + ["x" * 3000, " " * 2000 + "a", "ab" * 1500 + "'ll", "\n" * 1500, "a'" * 900, "we'" + "ll" * 400]
    for r in byte_bpe.round_trip(documents(spark, texts), chunk=chunk, overlap=overlap).collect():
        assert ids(r) == library.encode_ordinary(texts[r.doc_id]), texts[r.doc_id][:100]
        assert bytes(r.decoded) == texts[r.doc_id].encode()


def test_windows_that_share_no_boundary_go_round_again(spark, library):
    """A run longer than chunk and overlap has no boundary to stitch at."""
    text = "start " + "y" * 500 + " mid " + "1" * 300 + " end"
    coded = byte_bpe.encode_documents(documents(spark, [text]), chunk=20, overlap=5)
    (row,) = coded.withColumn("decoded", byte_bpe.decoded(coded.ids, byte_bpe.Ranks(spark, byte_bpe.RANKS))).collect()
    assert ids(row) == library.encode_ordinary(text) and bytes(row.decoded) == text.encode()


def test_every_merge_order_agrees(library):
    ranks = {piece: i for i, piece in enumerate(byte for byte in (bytes([b]) for b in range(256)))} | {
        b"aa": 300, b"aaaa": 301, b"ab": 299, b"ba": 302, b"aba": 303}
    rng = random.Random(5)
    for _ in range(300):
        piece = bytes(rng.choice(b"aab") for _ in range(rng.randrange(2, 60)))
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while True:
            pairs = [(ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks]
            if not pairs:
                break
            i = min(pairs)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        want = [ranks[p] for p in parts]
        assert byte_bpe._merge_by_heap(piece, ranks) == want
        assert byte_bpe.merge(piece, ranks) == ([ranks[piece]] if piece in ranks else want)


def test_merging_many_equals_merging_one():
    with open(byte_bpe.RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    rng = random.Random(6)
    pieces = [bytes(rng.choice(b"aeinst \xc3\xa9") for _ in range(rng.choice([1, 2, 3, 7, 12, 20, 32, 33, 90]))) for _ in range(900)]
    pieces += [text.encode()[:31] for text in mixed(8, 200, 10) if text]
    for piece, ids_ in zip(pieces, byte_bpe.Merger(ranks).merge(pieces), strict=True):
        whole = byte_bpe._merge_by_heap(piece, ranks) if len(piece) > 1 else [ranks[piece]]
        assert np.frombuffer(ids_, "<u4").tolist() == whole


def test_remembering_little_changes_nothing(spark, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    texts = mixed(9, 40, 30)
    with open(byte_bpe.RANKS, "rb") as file:
        encoder = byte_bpe.Encoder({base64.b64decode(a): int(b) for a, b in map(bytes.split, file)})
    split = byte_bpe.splitter()
    for i in range(0, 40, 5):
        found = encoder.encode([split(t) for t in texts[i:i + 5]])
        assert [np.frombuffer(x, "<u4").tolist() for x in found] == [library.encode_ordinary(t) for t in texts[i:i + 5]]


def test_split_classes_are_the_librarys(library):
    """Characters that newer tables call letters or digits split as in the library."""
    split = byte_bpe.splitter()
    for first, last in zip(byte_bpe.NEWER[::1], byte_bpe.NEWER[1:], strict=False):
        for c in {first, last, chr(ord(first) + 1), chr(ord(last) - 1)} - {"-"}:
            text = f"a{c}1{c} {c}!"
            assert [t for p in split(text) for t in library.encode_ordinary(p)] == library.encode_ordinary(text), hex(ord(c))


def test_bpe_query(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    rows = queries.op13_byte_bpe(spark, SF0001).collect()
    assert len(rows) == len(texts)
    for r in rows:
        tokens = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(tokens), hashlib.sha256(np.array(tokens, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_bpe_on_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    rows = byte_bpe.round_trip(docs).collect()
    assert sorted(bytes(r.decoded).decode() for r in rows) == sorted(r.text or "" for r in docs.collect())
    assert sum(r.doc_id is None for r in rows) == 3 and not any(len(r.ids) for r in rows if r.doc_id in (3, 4))
    assert byte_bpe.round_trip(docs.limit(0)).collect() == []


# ---- 12 alignment ---------------------------------------------------------

@pytest.fixture(scope="module")
def vocabularies():
    with open(alignment.VOCABULARY_A, "rb") as a, open(alignment.VOCABULARY_B, "rb") as b:
        return alignment.byte_level_vocabulary(a.read()), alignment.piece_vocabulary(b.read())


def test_vocabulary_a_encodes_as_the_library(vocabularies):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(alignment.VOCABULARY_A)
    tokenizer.encode_special_tokens = True
    newer = [f"a{c}1{c} {c}!" for c in byte_bpe.NEWER if c != "-"]
    texts = [*mixed(4, 300, 60), *newer, "x" * 3000, "ab " * 500, "<|endoftext|> <|endoftext|>", "\u200b\u00ad\u2028 \u3000x"]
    want = [x.ids for x in tokenizer.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert [x.tolist() for x in vocabularies[0].encode(texts)] == want


def brute_alignment(texts, a, b):
    """Token by token, pair by pair."""
    found, holders = [], defaultdict(set)
    for d, text in enumerate(texts):
        raw, x, y = (" " + (text or "")).encode(), *(v.encode([text])[0].tolist() if text else [] for v in (a, b))
        if not text or any(b"".join(v.pieces[i] for i in z) != raw for v, z in ((a, x), (b, y))):
            found.append(None)
            continue
        ends = [np.cumsum([len(v.pieces[i]) for i in z]).tolist() for v, z in ((a, x), (b, y))]
        groups, i, j = [], 0, 0
        for c in sorted(set(ends[0]) & set(ends[1])):
            p, q = ends[0].index(c) + 1, ends[1].index(c) + 1
            groups.append((x[i:p], y[j:q]))
            i, j = p, q
        links = Counter((p, q) for g, h in groups for p in g for q in h)
        for pair in links:
            holders[pair].add(d)
        found.append((len(x), len(y), groups, links))
    most = defaultdict(int)
    for (p, _), docs in holders.items():
        most[p] = max(most[p], len(docs))
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = f
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((n_a, n_b, len(groups), sum(links.values()),
                    sum(n for pair, n in links.items() if len(holders[pair]) == most[pair[0]]),
                    sum(n * len(holders[pair]) for pair, n in links.items()), hashlib.sha256(text.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("options", [{}, {"block_links": 300, "batch_bytes": 1500}])
def test_alignment_equals_brute_force(spark, vocabularies, options):
    texts = mixed(2, 120, 40) + ["", None, "x" * 2000, "é" * 500, "ab " * 900, "the the the", "the the the"]
    want = brute_alignment(texts, *vocabularies)
    assert 20 < sum(w[0] > 0 for w in want) < len(texts)
    rows = alignment.align_documents(documents(spark, texts).repartition(3), **options).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:] == want[r.doc_id], texts[r.doc_id]


def test_alignment_query(spark, vocabularies):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").orderBy("doc_id").collect()
    want = dict(zip([d.doc_id for d in docs], brute_alignment([d.text for d in docs], *vocabularies), strict=True))
    rows = queries.op12_cross_tokenizer_alignment(spark, SF0001).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == want


def test_long_groups_are_counted_by_multiplicity(vocabularies, monkeypatch):
    """Expanding every link and counting distinct identifiers give the same pairs."""
    strings = [f"{i}{s}" for s in alignment._SEPARATORS for i in range(60_000)]
    texts = ["x" * 700, "zq" * 300 + " the", "plain words here"]
    first = alignment.Aligned(texts, *vocabularies, strings)
    monkeypatch.setattr(alignment, "GROUP_LINKS", 0)
    second = alignment.Aligned(texts, *vocabularies, strings)
    for name in ("pair", "text", "links", "n_links"):
        assert getattr(first, name).tolist() == getattr(second, name).tolist()


def test_dense_and_sparse_bitmaps_round_trip():
    rng = random.Random(7)
    runs = [sorted(rng.sample(range(65_536), n)) for n in (1, 4096, 4097, 65_536, 3)]
    starts = np.cumsum([0, *map(len, runs)])[:-1]
    maps = alignment.bitmaps(np.concatenate(runs), starts).to_pylist()
    assert [len(m) for m in maps] == [2, 8192, 8192, 8192, 6]
    assert [alignment.marked(m, len(r)).tolist() for m, r in zip(maps, runs, strict=True)] == runs


def test_pair_counts(spark, vocabularies):
    _, postings = alignment.index_documents(documents(spark, ["a cat", "a cat a cat", "a dog"]))
    rows = {(r.a, r.b): r for r in alignment.pair_counts(postings).collect()}
    a, b = (v.pieces.index(b" cat") for v in vocabularies)
    assert (rows[a, b].n_docs, rows[a, b].n_links, rows[a, b].best) == (2, 3, True)


def test_alignment_on_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    rows = alignment.align_documents(docs).collect()
    assert len(rows) == docs.count()
    assert {tuple(r)[1:] for r in rows if r.doc_id in (3, 4)} == {(0, 0, 0, 0, 0, 0, "")}
    same = [tuple(r)[1:] for r in rows if r.doc_id in (1, 2)]
    assert len(same) == 3 and len(set(same)) == 1 and same[0][0] > 0
    assert alignment.align_documents(docs.limit(0)).collect() == []


def test_low_texts_split_as_the_pattern_says():
    """op12: texts of Latin letters alone are split by a pattern with its classes written out."""
    import regex

    dice = random.Random(11)
    chars = [chr(i) for i in range(byte_bpe._LOW)]
    texts = ["".join(dice.choices(chars + [" ", "'", "s", "l", "\n"] * 60, k=400)) for _ in range(300)] + ["".join(chars)]
    low, plain = byte_bpe._low_splitter(), regex.compile(byte_bpe.PATTERN).findall
    assert [low(t) for t in texts] == [plain(t) for t in texts] == [byte_bpe.splitter()(t) for t in texts]
    assert [low(t, 3) for t in texts] == [plain(t, 3) for t in texts]


def test_a_pre_token_is_looked_up_once_a_batch():
    """op12: every time that a pre-token came it was looked up among all that are remembered."""
    class Counted(dict):
        n = 0

        def __getitem__(self, key):
            Counted.n += 1
            return super().__getitem__(key)
    encoder = byte_bpe.Encoder({bytes([i]): i for i in range(256)})
    encoder.known = Counted()
    lists = [[" a", "bé", " a"] * 50, [], ["x" * 40, "bé"]]
    got = encoder.encode(lists)
    assert got == [b"".join(np.array(list(p.encode()), "<u4").tobytes() for p in pieces) for pieces in lists]
    assert Counted.n == 3
