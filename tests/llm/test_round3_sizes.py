"""What the operators send: it follows their input, not the number of buckets or rows that are not asked for."""

import random

import numpy as np
import pyarrow as pa

from seriesforge.llm import jaccard, packing, superminhash
from seriesforge.llm.common import written
from seriesforge.llm.tokens import Ids

DOCUMENTS = "doc_id long, text string"


def texts(rng, rows, words=150):
    return [(k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(words))) for k in range(rows)]


def test_index_does_not_grow_with_its_buckets(spark):
    docs = spark.createDataFrame(texts(random.Random(5), 300), DOCUMENTS).coalesce(1)
    none = spark.sparkContext.broadcast(np.zeros(0, np.uint64))

    def sent(bits):
        rows = jaccard.sampled_postings(docs, 5, 75, bits, none).collect()
        return sum(len(r[c] or b"") for r in rows for c in ("owners", "keys", "ids", "least")), sum(r["sent"] for r in rows)

    assert sent(3)[1] == sent(9)[1] == 0  # every posting that a list tells of was sent
    assert sent(9)[0] < 1.1 * sent(3)[0]


def test_steps_come_back():
    for x in ([], [0], [254, 255, 256], [0, 0, 3, 255, 511, 100_000], [1_000_000]):
        assert jaccard._from_steps(jaccard._steps(np.array(x, np.int64))).tolist() == x


def test_candidates_keep_all_that_are_linked(spark):
    rng = random.Random(6)
    rows = texts(rng, 60)
    for k in range(60):  # each near the threshold to one of the others
        words = rows[k][1].split()
        cut = rng.randint(15, 22)
        rows.append((100 + k, " ".join(words[cut:])))
    docs = spark.createDataFrame(rows, DOCUMENTS).repartition(4)
    none = spark.sparkContext.broadcast(np.zeros(0, np.uint64))
    kept = {r["point"] for r in jaccard.candidates(docs, 5, 75, 4, none).collect()}
    assert {jaccard.point_of(jaccard.shingles(t.encode())) for _, t in rows} <= kept
    alone = spark.createDataFrame(texts(random.Random(7), 60), DOCUMENTS)
    # A text that few of its shingles are sampled from stays, whatever the others are.
    assert jaccard.candidates(alone, 5, 75, 4, none).count() < 10


def test_only_sets_of_asked_pairs_travel(spark):
    sets = [np.arange(k, k + 40, dtype="<u8") for k in range(0, 4000, 4)]
    able = written(spark.createDataFrame([(k, bytearray(s.tobytes())) for k, s in enumerate(sets)], "point long, shingles binary"), "able")
    pairs = written(spark.createDataFrame([(1, 2), (1, 9)], "point long, pivot long"), "possible")
    got = superminhash.verified(pairs, able, 80)
    assert [tuple(r) for r in got.collect()] == [(1, 2)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2 and "hashpartitioning(point" not in plan


def test_frequent_words_stay_beside_words_that_occur_once():
    ids = Ids(packing.default_tokenizer(), most=40)
    asked = []
    whole = ids.piece
    ids.piece = lambda b: asked.append(b) or whole(b)
    for k in range(300):
        text = f"frequent wordno{'abcdefghij'[k % 10]}{'abcdefghij'[k // 10 % 10]}{'xyz'[k // 100]}"
        assert ids.of(text) == ids.by_file(text)
    assert sum(b.startswith(b"frequent") for b in asked) == 1
    assert len(ids) + len(ids.old) <= 40


def test_a_batch_merges_each_different_part_once():
    ids = Ids(packing.default_tokenizer())
    asked = []
    marked = ids.ends_marked

    class Counted:
        def encode_ordinary(self, text):
            asked.append(text)
            return marked.encode_ordinary(text)

    ids.ends_marked, ids.piece = Counted(), None
    texts = [f"Frequent, wordno{'abcdefghij'[k % 10]} FREQUENT frequent3 x2x." for k in range(300)]
    got = ids.of_all(pa.array(texts), b"\2\0").to_pylist()
    assert got == [ids.by_file(t) + b"\2\0" for t in texts]
    assert len(asked) == 1 and sorted(asked[0].split("\0")) == sorted(["", ",", ".", "2", "3", "frequent", "x", *(f"wordno{c}" for c in "abcdefghij")])


def test_a_batch_has_the_ids_of_its_file():
    rng = random.Random(3)
    ids = Ids(packing.default_tokenizer())
    texts = ["Don't we'll IT'S 3.14² ½", "İstanbul Σίσυφος ſ", "naïve ﬁ ＡＢ 中文 😀", "a b c\x85d", "x\x1cy", "<|endoftext|> z", "", " ", "µ ª ­", "a\0b \x7f"]
    signs = "".join(map(chr, [*range(0x20, 0x180), 0x1C4, 0x23A, 0x23E, 0x24F, 0x300, 0x30C, 0x3A3, 0x2028, 0x1F600]))
    texts += ["".join(rng.choices(signs + "abcIJS  " * 20, k=rng.randrange(60))) for _ in range(2000)]
    want = [ids.by_file(t) + b"\2\0" for t in texts]
    assert ids.of_all(pa.array(texts), b"\2\0").to_pylist() == want
    assert ids.of_all(pa.array(texts)[700:900], b"\2\0").to_pylist() == want[700:900]
    for few in (["", " "], ["<|"], [" \n"], []):
        assert ids.of_all(pa.array(few, pa.string()), b"\2\0").to_pylist() == [ids.by_file(t) + b"\2\0" for t in few]
