"""Near copies: crowded lists, and what the stage of the pipeline leaves."""

import random

import brute
import corpus_pipeline
from tidemill.llm import components, near_dedup


def _components(spark, texts):
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = near_dedup.near_duplicates(docs, words=4).collect()
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    return found, brute.near([{"doc_id": a, "text": b} for a, b in texts], 4)


def test_texts_around_a_common_passage(spark):
    passage = " ".join(f"c{i}" for i in range(40))
    texts = [(i, passage + " " + " ".join(f"o{i}x{j}" for j in range(20 + i % 7))) for i in range(150)]
    # some of them have a near copy
    texts += [(1000 + i, texts[i][1] + f" end{i}") for i in range(0, 150, 5)]
    found, plain = _components(spark, texts)
    assert found == plain
    assert found[1005][1] == 5 and found[6][1] == 6


def test_copies_around_the_threshold(spark, monkeypatch):
    split = []
    whole = near_dedup.whole_lists
    monkeypatch.setattr(near_dedup, "whole_lists", lambda *a: split.append(1) or whole(*a))
    draw = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(250):
        words = list(base)
        for place in draw.sample(range(120), draw.randint(0, 9)):
            words[place] = draw.choice([f"x{i}y{place}", f"shared{place}"])
        texts.append((i, " ".join(words)))
    found, plain = _components(spark, texts)
    assert found == plain
    assert split and 1 < len({c for _, c in found.values()}) < 250


def test_one_row_of_each_component_stays(spark):
    base = [f"w{i}" for i in range(100)]
    near = [" ".join(base + [f"end{i}"]) for i in range(4)]
    far = [" ".join(f"f{k}x{i}" for i in range(60)) for k in range(3)]
    rows = [
        (4, near[0], "a"), (3, near[1], "b"), (None, near[2], "c"), (3, near[3], "d"),  # one of id 3 stays
        (None, far[0], "e"), (None, far[0] + " more", "f"), (None, far[0], "e"),  # one without id stays
        (7, far[1], "g"), (7, far[2], "h"),  # one id, two texts
        (8, "", "i"), (9, None, "j"), (9, None, "j"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id string")
    left = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    marks = sorted(r["_id"] for r in left)
    assert len(marks) == 6 and marks[2:] == ["g", "h", "i", "j"]
    assert marks[0] in "bd" and marks[1] in "ef"


def test_the_stage_leaves_what_the_plain_version_leaves(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    plain = brute.near([r.asDict() for r in docs.collect()], 5)
    left = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert sorted(r.doc_id for r in left) == sorted(d for d, (_, c) in plain.items() if c == d)


def test_a_step_of_the_stars_reads_the_links_few_times(spark, capsys):
    links = spark.createDataFrame([(3, 1), (3, 2), (5, 3)], "u long, v long")
    links = components.stored(links, "links")
    components._small_star(components._large_star(links)).explain()
    assert capsys.readouterr().out.count("FileScan") <= 4


def test_rounds_without_new_links_leave_the_stars_alone(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(near_dedup, "shortened", lambda links: calls.append(1) or components.shortened(links))
    words = [f"w{i}" for i in range(60)]
    # of five texts around a common passage none is near another
    texts = [" ".join(words + [f"x{n}y{i}" for i in range(60)]) for n in range(5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert near_dedup.one_each(docs).count() == 5
    assert not calls
    # two copies among them are found in the first round alone
    more = docs.unionByName(spark.createDataFrame([(9, texts[0] + " end")], "doc_id long, text string"))
    assert {r["doc_id"] for r in near_dedup.one_each(more).collect()} == {0, 1, 2, 3, 4}
    assert len(calls) == 1


def test_stars_hold_the_components(spark):
    pick = random.Random(4)
    pairs = [(pick.randrange(90), pick.randrange(90)) for _ in range(60)] + [(200 + i, 201 + i) for i in range(20)]
    smallest = {n: n for pair in pairs for n in pair}
    for _ in smallest:
        for a, b in pairs:
            smallest[a] = smallest[b] = min(smallest[a], smallest[b])
    links = components.shortened(spark.createDataFrame(pairs, "u long, v long"))
    got = {r["node"]: r["root"] for r in components.labels(links).collect()}
    assert got == {n: s for n, s in smallest.items() if n in got}
    assert set(smallest) - set(got) == {a for a, b in pairs if a == b and not any(
        a in p and p[0] != p[1] for p in pairs)}
