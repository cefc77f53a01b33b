from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm.conftest import ODD, frame, texts_of
from tokenizers import Tokenizer

from citemill.llm import edit_tokens, packing, token_runs
from citemill.llm.queries import tokenizer_file

PATH = tokenizer_file()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check(tokenizer, texts, rows):
    """Every id is in one piece, sequences are gapless, and only the last of a task is padded."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    expected = defaultdict(list)
    for i, t in texts:
        expected[i].append(ids_of(tokenizer, t))
    assert set(pieces) == set(expected)
    for i, docs in expected.items():
        if len(docs) > 1:
            assert sum(r["length"] for r in pieces[i]) == sum(map(len, docs))
            continue
        place = 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            part = np.array(docs[0][place : place + r["length"]], dtype="<u4").tobytes()
            assert (r["start"], r["ids_crc32"], r["doc_tokens"]) == (place, zlib.crc32(part), len(docs[0]))
            place += r["length"]
        assert place == len(docs[0])
    padded = defaultdict(int)
    for s, own in sequences.items():
        place = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == place
            place += r["length"]
        assert place <= own[0]["tier"] <= 2048
        assert len({(r["tier"], r["step_group"]) for r in own}) == 1
        padded[s >> 32] += place != own[0]["tier"]
    assert all(n <= 1 for n in padded.values())
    return sequences


def test_round_trip(tokenizer, sample):
    sequences = check(tokenizer, texts_of(sample), packing.pack(sample, PATH).collect())
    assert {own[0]["tier"] for own in sequences.values()} == set(packing.TIERS)


def test_odd_rows(tokenizer, odd, spark):
    check(tokenizer, ODD, packing.pack(odd, PATH).collect())
    special = [(1, "a <|endoftext|>b"), (2, "Σίσυφος ΣΑΣ don't I'LL"), (3, "é ́x"), (4, "z" * 9000), (5, "w " * 9000)]
    check(tokenizer, special, packing.pack(frame(spark, special), PATH).collect())


def test_empty_table(nothing):
    assert packing.pack(nothing, PATH).count() == 0


def test_step_groups_of_a_tier_have_like_sizes_and_costs():
    packer, draw = packing.Packer(0), np.random.default_rng(5)
    room = packing.STEP_TOKENS // 2048
    costs = [int(draw.integers(2048, 2048**2)) for _ in range(room * packing.STEP_GROUPS)]
    packer.waiting[2048] = [(-c, i, [(i, c)]) for i, c in enumerate(costs)]
    groups = defaultdict(list)
    for _, cost, tier, group in packer.deal(2048):
        groups[group].append(cost)
    assert sorted(c for g in groups.values() for c in g) == sorted(costs)
    assert {len(g) for g in groups.values()} == {room}
    assert max(map(sum, groups.values())) < 1.05 * min(map(sum, groups.values()))


def test_pool_is_bounded():
    packer, draw, most = packing.Packer(0, high=50_000, low=10_000), np.random.default_rng(6), 0
    for doc in range(2000):
        for _ in packer.add(doc, bytes(4 * int(draw.integers(1, 9000)))):
            pass
        most = max(most, packer.tokens)
    assert most <= 50_000


def test_edit_counts_equal_a_full_recount(tokenizer, sample, spark, odd):
    for docs in (sample, odd):
        rows = edit_tokens.revisions(docs)
        found = edit_tokens.apply_listed(rows, PATH).collect()
        expected = []
        for r in rows.collect():
            text = old = (r["text"] or b"").decode()
            done, position, made = 0, 0, []
            for e in sorted((e["start"], e["end"], e["new"]) for e in r["edits"]):
                if e[0] >= position:
                    made.append(e)
                    position = e[1]
            for a, b, new in reversed(made):
                text = text[:a] + new + text[b:]
                done += 1
            expected.append((r["doc_id"], len(ids_of(tokenizer, old)) - 1, done, len(ids_of(tokenizer, text)) - 1))
        mine = [(r["doc_id"], r["n_tokens"], r["n_edits"], r["n_tokens_after"]) for r in found]
        assert sorted(mine, key=str) == sorted(expected, key=str)
        # Only touched segments are encoded again.
        assert all(r["n_reencoded"] <= 40 for r in found)


def test_edits_given_as_a_table(spark, nothing):
    docs = spark.createDataFrame([(1, "ab cd ef"), (2, "gh"), (None, "x")], "doc_id long, text string")
    edits = spark.createDataFrame(
        [(1, 2, 3, "", 0), (1, 1, 4, "overlaps", 0), (1, 90, 95, " more", 0), (3, 0, 0, "none", 0), (2, 0, 2, None, 0)],
        "doc_id long, start long, end long, replacement string, text int",
    )
    got = {r["doc_id"]: r for r in edit_tokens.count(docs, edits, PATH).collect()}
    encode = packing.encoder(PATH)
    total = lambda t: int(encode.counts([t]).sum())
    assert (got[1]["n_edits"], got[1]["n_skipped"]) == (2, 1)
    # The overlapping edit starts first, the cut after it is left out.
    assert got[1]["n_tokens_after"] == total("aoverlapsd ef more")
    assert got[2]["n_tokens_after"] == 0
    assert got[None]["n_edits"] == 0
    assert edit_tokens.count(nothing, edits, PATH).count() == 0


def test_sum_tree():
    tree = edit_tokens.SumTree(np.arange(11))
    tree.change(3, 7, 100)
    assert tree.total == 55 - 25 + 100
    tree.change(10, 10, 0)
    assert tree.total == 120


PIECES = ["a", "B", "é", "É", "í", "à", "ß", "×", ".", ",", "-", "'s", "'", " ", "\n", "\t", "1", "日", "Σ", "ς", "\u0301", "|",
          "<|endoftext|>", "<|", "re", "LL", "\u3000", "\x85", "\x00", "İ", "ÿ", "Ÿ", "_", "(", "œ", "ſ", "ﬁ", "\u200b", "😀"]


def test_any_text_has_the_ids_of_the_tokenizer(tokenizer):
    draw = np.random.default_rng(8)
    texts = ["".join(draw.choice(PIECES, int(draw.integers(0, 40)))) for _ in range(4000)]
    texts += ["", " ", "x" * 300_000, "word " * 100_000, "Ééß " * 1000]
    encode = token_runs.RunEncoder(PATH)
    assert encode.splits
    for part in (texts[:2000], texts[2000:], texts[1000:3000]):
        ids, bounds = encode([t.encode() for t in part])
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [ids_of(tokenizer, t)[:-1] for t in part]


def test_what_is_remembered_is_bounded(tokenizer, monkeypatch):
    monkeypatch.setattr(token_runs, "REMEMBERED_BYTES", 20_000)
    encode = token_runs.RunEncoder(PATH)
    for i in range(12):
        text = " ".join(f"{'abcdefghijkl'[i]}{chr(97 + j % 26)}{chr(97 + j // 26)}." for j in range(400))
        ids, _ = encode([text.encode()])
        assert ids.tolist() == ids_of(tokenizer, text)[:-1]
        assert encode.known.nbytes + encode.known_ids.nbytes <= 20_000
    assert token_runs.run_encoder(PATH) is token_runs.run_encoder(PATH)


def test_a_file_that_splits_otherwise_gets_whole_texts(spark, sample):
    path = tokenizer_file("byte_bpe_50k.json")
    assert not token_runs.RunEncoder(path).splits
    check(Tokenizer.from_file(path), texts_of(sample), packing.pack(sample, path).collect())
