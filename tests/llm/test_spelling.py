import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from docloom.llm import spelling as S
from docloom.llm.queries import op12_spelling
from tests.llm.helpers import edit_distance


def words_of(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def neighbours(words):
    """Every pair compared."""
    near = {w: [] for w in words}
    for a, b in itertools.combinations(words, 2):
        if abs(len(a) - len(b)) <= 1 and edit_distance(a, b) == 1:
            near[a].append(b)
            near[b].append(a)
    return near


def groups(words, ratio=5):
    """word -> (form, root, n, n_near, form_n)."""
    near, form = neighbours(words), {}
    for w, others in near.items():
        if others and words[best := min(others, key=lambda x: (-words[x], x))] >= ratio * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def table(frame):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in frame.collect()}


def vocabulary(seed, size, letters="abcé"):
    r = random.Random(seed)
    made = {"".join(r.choice(letters) for _ in range(r.randint(1, 7))) for _ in range(size)}
    return {w: int(5 * r.paretovariate(0.4)) % 100_000 + 5 for w in made}


def test_trie_finds_all_words_one_edit_away():
    words = sorted(vocabulary(1, 600)) + ["żółw", "żółwi"]
    trie = S.Trie.of(sorted(words), list(range(len(words))))
    for w in [*words, "", "a", "zzz", "abcabcabc", "żółwie"]:
        assert sorted(x for x, _ in trie.near(w)) == sorted(x for x in words if edit_distance(x, w) == 1), w


@pytest.mark.parametrize("characters, round_bytes", [(30, 900), (400_000, 32 << 20)])
def test_near_words_over_many_shards_and_rounds(spark, characters, round_bytes):
    words = vocabulary(2, 300)
    found = S.near_words(spark.createDataFrame(list(words.items()), "word string, n long"), characters, round_bytes)
    want = {w: (len(x), min(x, key=lambda o: (-words[o], o))) for w, x in neighbours(words).items() if x}
    assert {r["word"]: (r["n_near"], r["near"]) for r in found.collect()} == want


def test_groups_equal_brute_force(spark):
    words = vocabulary(3, 400)
    found = table(S.variant_groups(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert found == groups(words) and any(f and words[f] >= 5 * words[w] and r != f for w, (f, r, *_) in found.items())


def test_chain_of_forms_and_ties(spark):
    words = {"abcdef": 5, "abcdeg": 30, "abcdehg": 200, "abcdeh": 200, "abcdei": 5000, "zzzzzz": 9, "żzzzzz": 9}
    assert table(S.variant_groups(spark.createDataFrame(list(words.items()), "word string, n long"))) == groups(words)
    assert table(S.variant_groups(spark.createDataFrame([], "word string, n long"))) == {}


def test_counts_of_whole_texts(spark):
    r = random.Random(4)
    bag = ["Garden", "garden", "gardén", "GARDENS", "short", "Straße", "naïveté", "×÷×÷×÷", "1garden2", "ΩmegaÀÉÿ", "gar\nden"]
    docs = [(k % 40 if k % 9 else None, " ".join(r.choice(bag) for _ in range(60))) for k in range(80)]
    docs += [(500, None), (501, ""), (502, "garden " * 300_000), (503, "x" * 1_000_000 + " " + "x" * 1_000_000), (502, "y" * 200_000)] + [(504, "q" * 150_000)] * 5 + [(505, "q" * 149_999)] * 26
    frame = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id long, text string, word string, n int")
    counted = S.count_words(frame)
    assert {r["word"]: r["n"] for r in counted.collect()} == words_of(docs)
    found = table(S.variant_groups(counted))
    assert found == groups({w: n for w, n in words_of(docs).items() if len(w) < 100}) | {w: x for w, x in found.items() if len(w) > 100}
    assert found["q" * 150_000][:2] == ("q" * 149_999, "q" * 149_999)


def test_the_given_table(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert table(op12_spelling(spark, "/root/testdata/sf0.001")) == groups(words_of(docs))
