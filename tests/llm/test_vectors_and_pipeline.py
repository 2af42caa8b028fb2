import numpy as np
import pytest

import corpus_pipeline
from riskloom.llm import decontaminate, embedding_dedup, line_dedup, minhash, quality
from riskloom.session import pin

NAN, INF = float("nan"), float("inf")


def brute(rows):
    def sound(e):
        return e is not None and len(e) and all(x is not None and np.isfinite(x) for x in e) and any(e)

    unit = [None if not sound(e) or lab is None else np.asarray(e, float) / np.linalg.norm(e) for _, lab, e in rows]
    links = {i: set() for i in range(len(rows))}
    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and rows[i][1] == rows[j][1] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.93:
                links[i].add(j)
                links[j].add(i)
    out = []
    for i in range(len(rows)):
        reached, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - reached:
                reached.add(j)
                todo.append(j)
        known = [rows[j][0] for j in reached if rows[j][0] is not None]
        least = min(known, default=None)
        out.append((rows[i][0], len(links[i]), least, rows[i][0] == least))
    return sorted(out, key=str)


def groups(rng, n, size, dim, spread):
    centre = rng.normal(size=(n, 1, dim))
    return (centre + spread * rng.normal(size=(n, size, dim))).reshape(-1, dim)


@pytest.mark.parametrize("block", [1000, 6])
def test_vectors_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(3)
    v = np.concatenate([groups(rng, 12, 9, 64, s) for s in (0.05, 0.2, 0.27, 0.3)]).astype(np.float32)
    rows = [(i, i % 2 if i % 9 else 7, [float(x) for x in e]) for i, e in enumerate(v)]
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>"))
    got, want = {r[0]: r for r in got.collect()}, {r[0]: r for r in brute(rows)}
    missed = sum(want[i][1] - got[i][1] for i in want)
    assert all(got[i][1] <= want[i][1] for i in want) and missed <= 0.01 * sum(w[1] for w in want.values())


def test_vector_edges(spark):
    rows = [
        (1, 0, None), (2, 0, []), (3, 0, [0.0, 0.0]), (4, 0, [NAN, 1.0]), (5, 0, [INF, 1.0]), (6, 0, [None, 1.0]),
        (7, None, [1.0, 1.0]), (8, 0, [1.0, 1.0]), (8, 0, [1.0, 1.0]), (9, 0, [2.0, 2.1]), (None, 0, [3.0, 3.0]),
        (10, 1, [1.0, 1.0]), (11, 0, [1.0, 1.0, 1.0]), (12, 1, [1e30, 1e30]), (None, 2, [1.0, 0.0]), (13, 3, [1e-40, 1e-40]),
    ]
    table = spark.createDataFrame([(*r, "x", "x") for r in rows], "vec_id long, label int, embedding array<double>, node string, n string")
    got = embedding_dedup.near_vectors(table)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)
    assert embedding_dedup.near_vectors(table.filter("false")).count() == 0
    assert embedding_dedup.near_vectors(table.filter("vec_id < 4")).filter("n_links > 0").count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(400, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    turn = embedding_dedup.rotation(64, 0)
    assert np.allclose(turn @ turn.T, np.eye(64))
    signs, factor = np.sign(a @ turn.T), np.abs(a @ turn.T).sum(axis=1) / 8
    off = (signs @ (a @ turn.T).T) / (8 * factor[:, None]) - a @ a.T
    np.fill_diagonal(off, 0)
    assert abs(off.mean()) < 0.01
    error = np.sqrt(1 - np.minimum(1, (a @ a.T) ** 2)) * np.sqrt(1 / factor**2 - 1)[:, None] / np.sqrt(63)
    assert (np.abs(off) <= embedding_dedup.CONFIDENCE * error + 1e-9).mean() > 0.999


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    out["input"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = pin(stage(spark, docs, sf_dir), "test-stage")
    return out


def ids(df):
    return [r[0] for r in df.select("doc_id").collect()]


def test_stages_decide_as_their_operators(spark, sf_dir, stages):
    columns = stages["input"].columns
    assert all(stages[n].columns == columns for n in ("quality", "lines", "near_duplicates", "decontamination"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = quality.quality_scores(stages["input"], labels)
    assert sorted(ids(stages["quality"])) == sorted(ids(scores.filter("predicted = 1")))
    cleaned = {r["doc_id"]: r["text"] for r in line_dedup.drop_recurring_lines(stages["quality"]).collect()}
    assert all(cleaned[r["doc_id"]] == r["text"] and r["n_chars"] == len(r["text"]) for r in stages["lines"].collect())
    kept = ids(minhash.near_duplicates(stages["lines"]).filter("kept"))
    assert sorted(ids(stages["near_duplicates"])) == sorted(kept)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = set(ids(decontaminate.benchmark_leaks(stages["near_duplicates"], benchmark)))
    assert sorted(ids(stages["decontamination"])) == sorted(set(kept) - leaks)
    assert sorted(ids(stages["mixing"])) == sorted(ids(stages["decontamination"]))


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(tuple, stages["mixing"].collect()))
