"""Manifest, conversation repair and fingerprints against plain Python on small tables."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from riskloom.llm import conversation_repair, merkle, multiset_hash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- manifest -------------------------------------------------------------------------


def leaf(row):
    values = [row[c] for c in ("doc_id", "source", "lang", "n_chars", "text")]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def up(nodes):
    return [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]


def proof(levels, i):
    out = []
    for level in levels[:-1]:
        run = i // 8 * 8
        out.append((level[run:i], level[i + 1 : run + 8]))
        i //= 8
    return out


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append(up(levels[-1]))
    return levels


def plain_manifest(rows):
    first = lambda x: (x is not None, x if x is not None else 0)
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = {g: sorted((r for r in rows if r["lang"] == g), key=lambda r: (first(r["doc_id"]), leaf(r))) for g in langs}
    trees = {g: tree([leaf(r) for r in groups[g]]) for g in langs}
    top = tree([trees[g][-1][0] for g in langs])
    out = []
    for at, g in enumerate(langs):
        for i, r in enumerate(groups[g]):
            path = proof(trees[g], i) + proof(top, at)
            changed = dict(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["text"] is not None:
                changed["text"] = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
            h = leaf(changed)
            for left, right in path:
                h = sha("".join([*left, h, *right]))
            siblings = sha("".join(x for left, right in path for x in left + right))
            out.append((r["doc_id"], leaf(r), trees[g][-1][0], top[-1][0], siblings, h, h == top[-1][0]))
    return out


def documents(n, langs, seed):
    rng = random.Random(seed)
    text = lambda: rng.choice([None, "", "Ünï CODE", "plain", "A\nB", "x" * 5000, f"Text {rng.random()}"])
    rows = [{"doc_id": rng.choice([None, i, i, i, i // 2]), "text": text(), "lang": rng.choice(langs), "source": rng.choice([None, "", "src"]), "n_chars": rng.choice([None, 0, i])} for i in range(n)]
    return rows + rows[: n // 10]


@pytest.mark.parametrize(
    "n, langs",
    [(0, ["en"]), (1, [None]), (8, ["en"]), (9, ["en"]), (65, ["en", None, ""]), (700, ["en", "en", "en", "é", None]), (90, [f"l{i}" for i in range(75)]), (1100, ["one"])],
)
def test_manifest_is_the_plain_one(spark, n, langs):
    rows = documents(n, langs, n)
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in DOCS.split(", ")) for r in rows], DOCS)
    got = [tuple(r) for r in merkle.manifest_proofs(df.withColumn("key", F.lit(1)).withColumn("pos", F.lit(2))).collect()]
    key = lambda t: tuple(str(x) for x in t)
    assert sorted(got, key=key) == sorted(plain_manifest(rows), key=key)


def test_only_every_third_level_is_stored(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"), F.lit("t").alias("text"))
    made = merkle.manifest(docs)
    assert [level.count() for level in made.groups] == [5000, 10, 1]
    assert made.root() == merkle.regenerated([r["digest"] for r in made.groups[1].orderBy("pos").collect()], 10)[-1][0]


# --- conversations --------------------------------------------------------------------


def cheapest(rows):
    """By strings, from the last row to the first."""
    far = (10**9, "~")
    best = {s: ((0, "") if s in conversation_repair.DONE else far) for s in conversation_repair.FOLLOWS}

    def close():
        for _ in range(4):
            for s in best:
                for to in conversation_repair.insertions(s):
                    best[s] = min(best[s], (best[to][0] + conversation_repair.INSERT, "I" + best[to][1]))

    close()
    for row in reversed(rows):
        best = {s: min((best[to][0] + cost, letter + best[to][1]) for letter, cost, to in conversation_repair.edges(s, *row)) for s in best}
        close()
    return best[""]


@pytest.mark.parametrize("insert, delete", [(5, 2), (1, 4), (1, 1), (2, 3)])
def test_big_integers_find_the_cheapest_and_least(monkeypatch, insert, delete):
    monkeypatch.setattr(conversation_repair, "INSERT", insert)
    monkeypatch.setattr(conversation_repair, "DELETE", delete)
    conversation_repair.edges.cache_clear()
    rng = random.Random(insert * 10 + delete)
    for trial in range(500):
        n = rng.randint(0, 9) if trial < 470 else rng.randint(60, 300)
        rows = [(rng.choice(["s", "u", "a", "u", "a", "x", "", " "]), rng.choice([0, 0, 0, 0, 1, 2, 3])) for _ in range(n)]
        assert conversation_repair.repair(rows) == cheapest(rows)
    conversation_repair.edges.cache_clear()


def test_long_conversations_take_time_in_proportion():
    cost, audit = conversation_repair.repair([("u", 0)] * 50_001)
    assert (cost, audit) == (25_002, "D" + "KR" * 25_000)


def plain_repair(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        after = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            if kind == 0:
                continue
            if kind == 1:
                text = ""
            if kind == 2:
                text = "".join(c for c in text if c not in ".!?")
            if kind == 4:
                role = "user"
            after += [(turn, role, text)] * (2 if kind == 3 else 1)
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, pairs = set(), []
        for turn, role, text in after:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = 2 if not body else 3 if (role, text) in seen else 1 if body[-1] not in ".!?" else 0
            seen.add((role, text))
            pairs.append((role[:1], fault))
        turns = [t for t, _, _ in after if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = cheapest(pairs)
        lines, state, i = [], "", 0
        for letter in audit:
            expected = {"": "user", "s": "user", "u": "assistant", "a": "user"}[state]
            if letter == "I":
                lines.append((expected, ""))
            else:
                _, role, text = after[i]
                i += 1
                if letter == "D":
                    continue
                lines.append((role if letter == "K" else expected, text))
            state = lines[-1][0][:1]
        fs = [f for _, f in pairs]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        digest = sha("\n".join(f"{r}:{t}" for r, t in lines))
        out[conv] = (conv, gaps, fs.count(2), fs.count(3), fs.count(1), illegal, cost, audit, digest)
    return out


def test_conversations_are_repaired_as_by_hand(spark):
    rng = random.Random(3)
    texts = [None, "", " \n", "Well.", "Well. ", "Cut off", "So? ", "Yes!\t", "A.B", "é" * 3000 + ".", "same."]
    roles = ["system", "user", "assistant", "user", "assistant", None, "", "tool"]
    rows = [(rng.choice([None, *range(60)]), rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts)) for _ in range(900)]
    rows += rows[:80] + [(1000, t, rng.choice(roles), f"Turn {t // 7}.") for t in range(700)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("kind", F.lit(7)).withColumn("audit", F.lit("x"))
    got = {r[0]: tuple(r) for r in conversation_repair.damage_and_repair(df).collect()}
    assert got == plain_repair(rows)


def test_no_conversations(spark):
    assert conversation_repair.damage_and_repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# --- fingerprints ---------------------------------------------------------------------


def plain_lanes(text):
    lanes = [0] * 76
    for p in text.split("\n"):
        wide = sha("0|" + p) + sha("1|" + p)
        for i in range(16):
            lanes[i] += int(wide[8 * i : 8 * i + 8], 16)
        for at in range(0, len(p), 24):
            bits = int(hashlib.md5(p[at : at + 24].encode()).hexdigest()[:15], 16)
            for i in range(60):
                lanes[16 + i] += 1 if bits >> i & 1 else -1
    return [x % 2**32 for x in lanes]


def as_hex(lanes):
    return "".join(f"{x % 2**32:08x}" for x in lanes)


def plain_fingerprints(rows):
    texts = sorted({(d, t or "") for d, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{'~' if r[0] is None else r[0]}|{r[1]}".encode()).hexdigest()))
    follows = dict(zip(texts, [*texts[1:], texts[0]]))
    out = []
    for d, t in rows:
        t = t or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + follows[d, t][1][:half]
        out.append((d, len(t), sha(edited), as_hex(plain_lanes(t)), as_hex(plain_lanes(edited))))
    return out


def test_fingerprints_are_the_plain_ones(spark):
    rng = random.Random(9)
    line = lambda: rng.choice(["", "short", "a line of more than a few words that goes on", "é𝄞" * 30, "x\r", " sep"])
    rows = [(rng.choice([None, i, i, i]), rng.choice([None, "", "\n".join(line() for _ in range(rng.randint(1, 9)))])) for i in range(120)]
    rows += rows[:15] + [(500, "w " * 60_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("lanes", F.lit(2))
    got = multiset_hash.fingerprints(df).collect()
    key = lambda t: tuple(str(x) for x in t)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(plain_fingerprints(rows), key=key)
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if r["fingerprint"] == r["edited_fingerprint"]:
            assert r["near_edited"] == 1


@pytest.mark.parametrize("rows", [[], [(1, "alone")], [(1, None), (1, None)]])
def test_few_documents(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = multiset_hash.fingerprints(df).collect()
    assert len(got) == len(rows)
    assert all(r["near_next"] == 1 for r in got)


def test_paragraphs_come_and_go_in_any_order(spark):
    texts = ["one\ntwo\nthree", "three\none\ntwo", "two", "one\nthree", "one\ntwo\nthree\ntwo"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, body string")
    made = multiset_hash.with_lanes(df, ["id"]).select("id", multiset_hash.to_hex(F.col("lanes")).alias("fp"))
    fp = {r["id"]: r["fp"] for r in made.collect()}
    assert fp[0] == fp[1] != fp[4]
    row = spark.createDataFrame([(fp[0], fp[2])], "a string, b string").select(
        multiset_hash.deleted(F.col("a"), F.col("b")).alias("less"), multiset_hash.inserted(F.col("a"), F.col("b")).alias("more")
    )
    assert tuple(row.first()) == (fp[3], fp[4])


def test_likeness_follows_shared_text(spark):
    rng = random.Random(2)
    words = lambda n: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))
    lines = [words(40) for _ in range(40)]
    texts = {0: "\n".join(lines), 1: "\n".join(lines[:20] + [words(40) for _ in range(20)]), 2: words(1600)}
    df = spark.createDataFrame(list(texts.items()), "id int, body string")
    lanes = {r["id"]: r["lanes"] for r in multiset_hash.with_lanes(df, ["id"]).collect()}
    pairs = spark.createDataFrame([(lanes[0], lanes[1]), (lanes[0], lanes[2]), (lanes[0], lanes[0])], "a array<int>, b array<int>")
    half, none, same = [r[0] for r in pairs.select(multiset_hash.likeness(F.col("a"), F.col("b"))).collect()]
    assert abs(half - 0.5) < 0.3 and none < 0.35 and same == 1
