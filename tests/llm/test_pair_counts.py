"""Alignment of two tokenizers against whole-text encoding by the named files and plain loops."""

import hashlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import Row

from frostline.llm import pair_counts
from frostline.llm.common import Stages, table

DOCUMENT = "doc_id bigint, text string, n_best string, count_sum string, chunk int, node string"


@pytest.fixture(scope="module")
def tokenizers():
    return pair_counts.Tokenizers.public()


@pytest.fixture(scope="module")
def plain():
    """Both tokenizers as (ids, byte strings) of a whole text, independent of the operator."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(c): c for c in shown} | {chr(256 + n): c for n, c in enumerate(c for c in range(256) if c not in shown)}

    def run_a(text):
        ids = a.encode(" " + text, add_special_tokens=False).ids
        return ids, [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids]

    def run_b(text):
        ids = b.encode(text)
        spell = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        return ids, [spell(i) for i in ids]

    return run_a, run_b


def by_hand(rows, plain):
    def groups_of(text):
        (a, a_bytes), (b, b_bytes) = plain[0](text), plain[1](text)
        if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            return []
        ends_a, ends_b = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
        both, out, i, j = sorted(set(ends_a) & set(ends_b)), [], 0, 0
        for end in both:
            k, m = bisect_left(ends_a, end) + 1, bisect_left(ends_b, end) + 1
            out.append((a[i:k], b[j:m]))
            i, j = k, m
        return out

    groups = [groups_of(r.text) if r.text else [] for r in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    counts = Counter(pair for link in links for pair in link)
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for r, g, link in zip(rows, groups, links):
        spelled = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((r.doc_id, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(link.values()),
                    sum(n for p, n in link.items() if counts[p] == best[p[0]]), sum(n * counts[p] for p, n in link.items()),
                    hashlib.sha256(spelled.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


def scored(docs, tokenizers, spark):
    return sorted((tuple(r) for r in pair_counts.align(docs, tokenizers, Stages(spark)).collect()), key=str)


def awkward_rows():
    row = lambda n, text: Row(doc_id=n, text=text, n_best="x", count_sum=None, chunk=3, node="y")
    texts = [None, "", " ", "  ", "a  b", " lead", "trail ", "\n\n tab\t", "mark ▁ inside", "▁", "<|endoftext|> <s> </s> <unk> <0x41>", "漢字かな交じり文 ，。", "👩‍👩‍👧 emoji🎉🎉🎉",
             "ﬁ ligature　wide", "a\u0000b", "�​‮", "x" * 3000, "9" * 5000, "=" * 777 + " " * 50 + "end", "don't we'll I'M", "é é", "Ünïcödé " * 400,
             "𝔘𝔫𝔦𝔠𝔬𝔡𝔢 " * 30, "word " * 20000,
             " " * 300_000 + "end", "a\n" + "\n \t" * 100_000 + "b", "\n" * 400_000]
    rows = [row(n, t) for n, t in enumerate(texts)]
    return rows + [row(100, "one hot copy of a text")] * 60 + [row(None, "no id")] * 2


def test_whole_table_equals_plain_loops(spark, sf_dir, tokenizers, plain):
    docs = table(spark, sf_dir, "documents")
    assert scored(docs, tokenizers, spark) == by_hand(docs.collect(), plain)


def test_awkward_rows_in_small_parts_and_deep_trees(spark, tokenizers, plain, monkeypatch):
    """One vector per branch of two, a table of many parts and crowded groups give the same rows."""
    rows = awkward_rows()
    docs = spark.createDataFrame(rows, DOCUMENT).repartition(7)
    want = by_hand(rows, plain)
    assert scored(docs, tokenizers, spark) == want
    monkeypatch.setattr(pair_counts, "BRANCH", 2)
    made = pair_counts.pair_table(docs, tokenizers, Stages(spark))
    total = made.selectExpr("sum(octet_length(keys) + octet_length(bits) + octet_length(counts))").first()[0]
    parts = pair_counts.parts_of(made, total // 3)
    assert len(parts) >= 3 and sum(map(len, parts)) == made.count()
    got = pair_counts.score(docs, made, tokenizers, Stages(spark), table_bytes=total // 3)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_crowded_groups_count_ids_first(tokenizers, plain, monkeypatch):
    texts = [r.text for r in awkward_rows() if r.text]
    usual = pair_counts.Aligned(texts, tokenizers).links(tokenizers.width)
    monkeypatch.setattr(pair_counts, "CROWDED_LINKS", 1)
    counted = pair_counts.Aligned(texts, tokenizers).links(tokenizers.width)

    def as_counter(links):
        out = Counter()
        for key, group, times in zip(*(c.tolist() for c in links)):
            out[key, group] += times
        return out

    assert as_counter(usual) == as_counter(counted) and len(counted[0]) < len(usual[0])


def test_no_rows(spark, tokenizers):
    assert scored(spark.createDataFrame([], DOCUMENT), tokenizers, spark) == []
    empty = spark.createDataFrame([Row(doc_id=1, text=None, n_best=None, count_sum=None, chunk=None, node=None)], DOCUMENT)
    assert scored(empty, tokenizers, spark) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_hash_is_minimal_perfect_and_verified():
    width = 32_000
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 50_000 * width, 40_000))
    rows = []
    for chunk in range(pair_counts.CHUNKS):
        own = keys[pair_counts.chunk_of(keys, width) == chunk]
        sizes, bits, ordered = pair_counts.hash_levels(own)
        rows.append(Row(chunk=chunk, sizes=sizes, bits=bits.tobytes(), keys=ordered.tobytes(), counts=ordered.tobytes()))
    made = pair_counts.PairTable(rows, width)
    assert sorted(made.number(keys).tolist()) == list(range(len(keys)))
    assert (made.counts[made.number(keys)] == keys).all()
    absent = np.setdiff1d(rng.integers(0, 50_000 * width, 10_000), keys)
    assert (made.number(absent) == -1).all()
    assert len(made.bits) * 8 < 8 * len(keys) + 64 * pair_counts.CHUNKS * 8


def test_spelled_groups(spark, tokenizers):
    docs = spark.createDataFrame([Row(doc_id=1, text="don't"), Row(doc_id=2, text="")], "doc_id bigint, text string")
    got = {r.doc_id: r.groups for r in pair_counts.spelled_groups(docs, tokenizers).collect()}
    assert got[2] == "" and all(side.replace(",", "").isdigit() for g in got[1].split(";") for side in g.split("|"))
