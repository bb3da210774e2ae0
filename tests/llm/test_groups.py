"""Near duplicates, shards, classifiers and the pipeline against plain loops."""

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from tidemark.llm import near_dups, quality_trees, sharding, toxicity

from .support import ODD, empty, labels, odd, prose, table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or (frozenset([tuple(w)]) if w else frozenset())


def components(texts, percent):
    sets = {k: shingle_set(t) for k, t in texts.items()}
    parent = {k: k for k in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(texts)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in texts}, {k: len(s) for k, s in sets.items()}


def edited(words, edits, seed):
    draw = random.Random(seed)
    out = list(words)
    for k in range(edits):
        out[draw.randrange(len(out))] = f"new{seed}x{k}"
    return " ".join(out)


@pytest.mark.parametrize("few", [(16, 64), (3, 2)])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(near_dups, "FEW", few[0])
    monkeypatch.setattr(near_dups, "FEW_ELEMENTS", few[1])
    long = [f"w{i}" for i in range(90)]
    other = [f"v{i}" for i in range(60)]
    texts = [edited(long, s % 5, s) for s in range(45)] + [" ".join(long), " ".join(long), " ".join(long).upper(), " ".join(long[:80]), " ".join(long[7:])]
    texts += [edited(other, s % 3, 1000 + s) for s in range(12)] + [*ODD, "one", "One", "a b c d", "a b  c d"] + [edited(texts[4].split(), 1, 2000 + s) for s in range(12)]
    docs = table(spark, texts)
    want, sizes = components(dict(enumerate(texts, 1)), 85)
    rows = near_dups.near_duplicates(docs, 85).collect()
    assert len(rows) == len(texts)
    assert {r.doc_id: r.component_id for r in rows} == want
    assert all(r.n_shingles == sizes[r.doc_id] and r.kept == (want[r.doc_id] == r.doc_id) for r in rows)


def test_components_of_a_large_group_of_near_copies(spark):
    # 700 versions of two texts that share most of their words, some of them a link away from their text, some two
    base = [f"w{i}" for i in range(120)]
    other = base[:60] + [f"v{i}" for i in range(60)]
    texts = [edited(base if s % 3 else other, s % 6, s) for s in range(500)]
    texts += [edited(texts[s].split(), 1 + s % 3, 9000 + s) for s in range(200)]
    want, _ = components(dict(enumerate(texts, 1)), 85)
    got = {r.doc_id: r.component_id for r in near_dups.near_duplicates(table(spark, texts), 85).collect()}
    assert got == want


def test_deduplication_judges_rows_and_not_ids(spark):
    docs = table(spark, ["unused"]).limit(0)
    same, other = prose(1, 60), prose(2, 60)
    docs = docs.unionByName(table(spark, [same], 3)).unionByName(table(spark, [same], 5)).unionByName(table(spark, [other], 5))
    docs = docs.unionByName(table(spark, [""], 5)).unionByName(table(spark, [""], 6)).unionByName(table(spark, [other], 5))
    assert sorted((r.doc_id, r.text) for r in near_dups.deduplicated(docs).collect()) == sorted([(3, same), (5, other), (5, ""), (6, "")])


def test_dropped_keys_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "MOST_BROADCAST", 0)
    monkeypatch.setattr(near_dups, "MOST_LEADER_BYTES", 0)
    monkeypatch.setattr(near_dups, "FEW", 3)
    texts = [edited([f"w{i}" for i in range(90)], s % 3, s) for s in range(20)] + ["one", prose(9, 50)]
    want, _ = components(dict(enumerate(texts, 1)), 80)
    assert sorted(r.doc_id for r in near_dups.deduplicated(table(spark, texts)).collect()) == sorted(set(want.values()))


def test_near_duplicates_of_odd_rows(spark):
    docs = odd(spark)
    rows = near_dups.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)]
    assert {r.component_id for r in rows if r.doc_id in (6, 7)} == {6}
    left = near_dups.deduplicated(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id) == [1, 2, 3, 4, 5, 6, 8, 9]
    assert near_dups.near_duplicates(empty(spark)).count() == 0
    assert near_dups.deduplicated(empty(spark)).count() == 0


def test_pruning_keeps_what_may_reach_the_threshold():
    least = near_dups.least_matches(0.85, 1e-6)
    assert all(a < b for a, b in zip(least, least[1:], strict=False))
    assert all(0.5 < m / n < 0.85 for m, n in zip(least[1:], range(50, 126, 25), strict=True))


def test_shards(spark):
    texts = ["same"] * 300 + [f"t{i % 60}" for i in range(180)] + [f"alone {i}" for i in range(517)] + [None, None, "", ""]
    docs = table(spark, texts)
    rows = sharding.shard(docs, 7).collect()
    assert len(rows) == len(texts)
    counts = Counter(r.shard for r in rows)
    assert set(counts) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    slots = defaultdict(list)
    of_text = defaultdict(set)
    for r in rows:
        text = texts[r.doc_id - 1]
        data = (text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "rows", None)
        slots[r.shard].append(r.slot)
        of_text[text].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len(of_text["same"]) <= 4
    assert sum(len(of_text[f"t{i}"]) > 1 for i in range(60)) <= 2
    assert sharding.shard(odd(spark), 4).count() == odd(spark).count()
    assert sharding.shard(empty(spark), 4).count() == 0


def test_shards_follow_further_links(spark):
    draw = random.Random(1)
    docs = table(spark, [f"alone {i}" for i in range(200)])
    ids = list(range(1, 201))
    draw.shuffle(ids)
    pairs = [(a, b) for g in range(20) for a in ids[g * 4 : g * 4 + 1] for b in ids[g * 4 + 1 : g * 4 + 4]]
    links = spark.createDataFrame([(b, a, 300) for a, b in pairs] + [(a, b, 1) for a, b in pairs], "a long, b long, weight long")
    at = {r.doc_id: r.shard for r in sharding.shard(docs, 4, links).collect()}
    counts = Counter(at.values())
    assert max(counts.values()) - min(counts.values()) <= 1
    assert sum(at[a] != at[b] for a, b in pairs) <= 0.1 * len(pairs)  # three in four by chance


def test_cut_links_come_near_the_least(spark):
    # two rings of five joined by one link: the least cut into halves, by brute force, is one link
    pairs = [(g * 5 + i, g * 5 + (i + 1) % 5) for g in range(2) for i in range(5)] + [(0, 5)]
    least = min(sum((a in half) != (b in half) for a, b in pairs) for half in combinations(range(10), 5))
    both = [(a + 1, b + 1, 1) for a, b in pairs] + [(b + 1, a + 1, 1) for a, b in pairs]
    links = spark.createDataFrame(both, "a long, b long, weight long")
    docs = table(spark, [f"alone {i}" for i in range(10)])
    at = {r.doc_id: r.shard for r in sharding.shard(docs, 2, links, rounds=12).collect()}
    assert sorted(Counter(at.values()).values()) == [5, 5]
    assert sum(at[a + 1] != at[b + 1] for a, b in pairs) <= least + 3  # about half of eleven by chance


def test_rounds_form_the_shards(spark):
    texts = [f"t{i % 150}" for i in range(600)] + [f"alone {i}" for i in range(400)]
    folder = sharding.scratch(spark, "test")
    nodes = table(spark, texts).selectExpr("doc_id AS node", "doc_id", "md5(text) AS group")
    quota = [250] * 4
    labels, ties = sharding._propagated(nodes, None, 4, quota, folder, 8)
    hashed = nodes.selectExpr("node", "cast(pmod(xxhash64(node), 4) AS int) AS shard")
    before, after = (sharding.cut_share(x, ties).first() for x in (hashed, labels))
    assert before.links == after.links == 2 * 450
    assert before.cut > 0.6 * before.links and after.cut <= 0.02 * after.links
    seeded = sharding.seeds(sharding.numbered(nodes.select("node", "group"), f"{folder}/2"), quota, f"{folder}/2", 31)
    assert seeded.where("shard IS NOT NULL").count() == 150  # one row of each group; rounds give the others theirs


def test_toxicity_on_held_out_rows(spark):
    draw = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    texts = [prose(i, 40, words) + (f" bad{draw.randrange(4)} " if i % 3 == 0 else " ") + prose(5000 + i, 40, words) for i in range(900)]
    docs = table(spark, texts)
    marks = labels(spark, [(i + 1, 1, int(i % 3 == 0)) for i in range(900)])
    rows = toxicity.scored(docs, marks).collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.predicted == int((r.doc_id - 1) % 3 == 0) for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert toxicity.scored(odd(spark), marks).count() == odd(spark).count()
    assert toxicity.scored(odd(spark), marks.limit(0)).count() == odd(spark).count()
    assert toxicity.scored(empty(spark), marks).count() == 0


def test_toxicity_is_placed_on_all_labelled_rows(spark):
    draw = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    toxic = [i % 9 == 0 for i in range(2700)]
    # both labels hold the same words, toxic rows more often, so that the best cut depends on the shares
    texts = [prose(i, 25, words) + (f" bad{draw.randrange(4)}" if draw.random() < (0.7 if t else 0.2) else "") for i, t in enumerate(toxic)]
    docs, marks = table(spark, texts), labels(spark, [(i + 1, 1, int(t)) for i, t in enumerate(toxic)])
    model, thresholds = toxicity.fitted(docs, marks, most=150)
    placed = [i for i in range(2700) if zlib.crc32(str(i + 1).encode()) % 5 and zlib.crc32(str(i + 1)[::-1].encode()) % 5 == 1]
    z, y = toxicity.Texts.of([texts[i] for i in placed]).logits(model, np.arange(len(placed))), np.array([toxic[i] for i in placed])
    f1 = lambda cut: 2 * y[z >= cut].sum() / ((z >= cut).sum() + y.sum())
    assert f1(0.0) >= max(f1(c) for c in z) - 0.02
    assert thresholds["en"] == pytest.approx(0.5)
    model.middle += 1.0  # counts follow the model and hold each labelled row once
    counts = toxicity.counted(docs.unionByName(docs), marks, model)
    assert sum(sum(n) for n in counts["en"].values()) == len(placed)


def test_quality_trees_on_held_out_rows(spark):
    texts = [prose(i, 60) if i % 4 else " ".join(w + "##" for w in prose(i, 60).split()) for i in range(600)]
    docs = table(spark, texts)
    marks = labels(spark, [(i + 1, int(i % 4 > 0), 0) for i in range(600)])
    rows = quality_trees.scored(docs, marks).collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.predicted == int((r.doc_id - 1) % 4 > 0) for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert quality_trees.scored(odd(spark), marks).count() == odd(spark).count()
    assert quality_trees.scored(odd(spark), marks.limit(0)).count() == odd(spark).count()
    assert quality_trees.scored(empty(spark), marks).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    words = [f"w{i}" for i in range(500)]
    base = [prose(i, 80, words) for i in range(30)]
    item = prose(900, 30, words)
    texts = [*base, base[0], edited(base[1].split(), 1, 5), base[2] + " " + item, prose(950, 80, words) + " token=abcdefghijklmnopqrst", "too short", None, prose(7, 30, words) + " " + "a b c d e f g h " * 20]
    table(spark, texts).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark, [(1, 1, 0)]).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept.append({r.doc_id for r in docs.collect()})
    assert kept[0] == set(range(1, 35))
    assert kept[1] == set(range(1, 31)) | {33, 34}
    assert kept[2] == kept[3] == set(range(1, 31)) | {34}
    assert docs.where("doc_id = 34").first().text.endswith(" [secret]")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} == kept[3]
