"""Reply trees, ranked search and the Merkle manifest against brute force."""
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelake.llm import merkle, ranked_search as rs, reply_trees as rt
from carelake.llm.queries import held_out

CONTROL = ["[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "<a>", "<|role=", "|>", "</turn>"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# reply trees

def odd_strings(n):
    rng = random.Random(5)
    parts = [*CONTROL, "[", "<", "|", ">", "~", "~~", "\\", "$0", " ", "\n", "é😀", "INST]", "/s>", "x", "["]
    return ["", *CONTROL, *("".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(n))]


def test_escape_is_reversible_and_leaves_no_control_string(spark):
    texts = odd_strings(3000)
    rows = (spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", rt.escape(F.col("t")))
            .withColumn("back", rt.unescape(F.col("e"))).collect())
    for r in rows:
        assert r.back == r.t
        assert not any(c in r.e for c in (*CONTROL, "<|"))
        if not any(c in re.sub("~", "", r.t) for c in (*CONTROL, "<|")):
            assert r.e == r.t


def test_conversations_read_back(spark):
    rng = random.Random(6)
    texts, roles = odd_strings(400), ["user", "assistant", "system", "", "tool", "a|", "> x", "end", "</turn>", None]
    rows = [(c, t, rng.choice(roles), rng.choice([*texts, None])) for c in range(60) for t in range(rng.randint(1, 9))]
    rows += [(70, None, "user", "no turn"), (70, 1, "assistant", "b"), (70, 1, "assistant", "a"), (70, 1, "assistant", "a"),
             (None, 0, "user", "no id"), (None, 1, "assistant", "x" * 200_000), (-7, 0, "user", "</s>[INST] ok [/INST]")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("tree", F.lit(1)).withColumn(
        "node", F.lit("clash"))
    got = {r.conv_id: r for r in rt.conversation_digest(df).collect()}
    want = collections.defaultdict(list)
    for c, t, role, text in rows:
        want[c].append((t is not None, t or 0, role is not None, role or "", text is not None, text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        turns = [(t[3], t[5]) for t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
    assert rt.conversation_digest(df.limit(0)).count() == 0


def test_branches_of_trees(spark):
    rng = random.Random(7)
    rows, parents = [], {}
    for tree in ("t1", "t2", "t3"):
        for node in range(1, 80):
            parent = rng.choice([None, *range(max(1, node - 6), node)]) if node > 1 else None
            rows.append((tree, node, parent, rng.choice([None, 0.0, 1.0, 2.5, -1.0])))
    rows += [("orphan", 5, 99, 1.0), ("orphan", 6, 5, 1.0), ("loop", 1, 2, 0.0), ("loop", 2, 1, 0.0), ("loop", 3, 2, 9.0),
             ("loop", 4, None, 0.0), ("self", 1, 1, 0.0)]
    rows += [("deep", i, i - 1 if i else None, 0.0) for i in range(300)]
    for tree, node, parent, _ in rows:
        parents[tree, node] = parent
    score = {(t, n): s or 0 for t, n, _, s in rows}
    want = {}
    for tree, node in parents:
        if any(t == tree and p == node for (t, _), p in parents.items()):
            continue
        path, at = [], node
        while at is not None and (tree, at) in parents and at not in path:
            path.append(at)
            at = parents[tree, at]
        if at in path:
            continue
        want[tree, node] = path[::-1]
    df = spark.createDataFrame(rows, "tree string, node long, parent long, score double")

    def paths(frame):
        out = collections.defaultdict(list)
        for r in frame.collect():
            out[r.tree, r.leaf].append((r.pos, r.node, r["rank"]))
        return {k: sorted(v) for k, v in out.items()}
    got = paths(rt.branches(df))
    assert {k: [n for _, n, _ in v] for k, v in got.items()} == want
    assert all([p for p, _, _ in v] == list(range(len(v))) for v in got.values())
    best = paths(rt.branches(df, keep=3))
    for tree in {t for t, _ in want}:
        ranked = sorted((k for k in want if k[0] == tree), key=lambda k: (-sum(score[tree, n] for n in want[k]), k[1]))[:3]
        assert sorted((v[0][2], k) for k, v in best.items() if k[0] == tree) == [(i + 1, k) for i, k in enumerate(ranked)]
    texts = df.withColumn("role", F.lit("user")).withColumn("text", F.concat(F.lit("m"), F.col("node")))
    formatted = {(r.tree, r.leaf): r.formatted for r in rt.format_branches(texts, rt.branches(df, keep=1)).collect()}
    assert formatted["orphan", 6] == "<s>[INST] m5 [/INST][INST] m6 [/INST]"
    assert rt.branches(df.limit(0), keep=1).count() == 0


# ranked search

def words(text):
    return [w.translate({c: c + 32 for c in range(65, 91)})
            for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def ranked_by_brute_force(docs, items, k):
    held = [(i, collections.Counter(w), len(w)) for i, w in ((i, words(t)) for i, t in docs) if w]
    total, terms = len(held), sum(n for _, _, n in held)
    df = collections.Counter(t for _, c, _ in held for t in c)
    wanted = collections.defaultdict(set)
    for i, t in items:
        wanted[i] |= set(words(t))
    out = []
    for item, own in wanted.items():
        rows = []
        for i, c, n in held:
            m = 50 + 50 * n * total // terms
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in own if t in c)
            if s > 0:
                rows.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if x[1] else x[2], -x[0]) for r, x in enumerate(sorted(rows)[:k])]
    return sorted(out, key=str)


def corpus(rng, n, vocabulary):
    return [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))) for i in range(n)]


@pytest.mark.parametrize("terms", [20_000, 40])
def test_ranked_search_equals_brute_force(spark, monkeypatch, terms):
    monkeypatch.setattr(rs, "TERMS", terms)  # 40: several blocks of items
    rng = random.Random(8)
    vocabulary = [f"w{int(rng.paretovariate(0.6))}" for _ in range(400)] + ["Été", "ÉTÉ", "été", "naïve", "日本", "x_y", "A-b"]
    docs = corpus(rng, 700, vocabulary)
    docs += [(700, None), (701, ""), (702, " -- ,"), (None, docs[3][1]), (3, docs[5][1]), (703, docs[3][1]), (704, docs[3][1]),
             (705, "w1 " * 30_000 + "w2")]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 25)))) for i in range(12)]
    items += [(20, None), (21, ""), (22, "never seen"), (None, "w1 w2 w3"), (3, "w5 w6"), (30, " ".join(vocabulary[:200]))]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(1)).withColumn("score", F.lit("x"))
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("x"))
    got = [tuple(r) for r in rs.ranked_search(d.repartition(5), i, k=7).collect()]
    assert sorted(got, key=str) == ranked_by_brute_force(docs, items, 7)


def test_ranked_search_of_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    i = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert rs.ranked_search(d.limit(0), i).count() == 0 == rs.ranked_search(d, i.limit(0)).count()


def test_presence_masks_leave_out_documents_below_the_floor():
    """More than 64 terms, and groups that are never scored."""
    rng = np.random.default_rng(3)
    n, vocabulary = 2000, 150
    lists = [np.flatnonzero(rng.random(vocabulary) < 0.02 + 0.9 * (i % 200 == 0)) for i in range(n)]
    lengths = np.array([len(x) for x in lists])
    terms = np.concatenate(lists).astype(np.int32)
    counts = rng.integers(1, 4, len(terms))
    weights = rng.integers(0, 4000, vocabulary)
    block = rs.DocumentBlock(np.full(n, 200), lengths, terms, counts, weights, 10_000, 2_000_000)
    best = rs.Best(5)
    scored = block.search(np.arange(vocabulary), best, np.zeros(n, bool), np.arange(n))
    per = np.add.reduceat(weights[terms] * ((10 ** 9 * counts) // (1000 * counts + 20 * 100)),
                          np.concatenate(([0], np.cumsum(lengths)[:-1])).clip(max=len(terms) - 1))
    per[lengths == 0] = 0
    order = np.lexsort((np.arange(n), -per))[:5]
    assert best.doc.tolist() == order.tolist() and best.score.tolist() == per[order].tolist()
    assert scored < n / 4


# Merkle manifest

def test_addresses_are_a_van_emde_boas_order():
    for levels in range(1, 6):
        at = [merkle.veb_address(d, i, levels) for d in range(levels) for i in range(8 ** d)]
        assert sorted(at) == list(range(merkle.veb_size(levels)))
    # five levels: two on top (9 nodes), then 64 subtrees of three levels (73 nodes)
    assert [merkle.veb_address(0, 0, 5), merkle.veb_address(1, 7, 5), merkle.veb_address(2, 3, 5)] == [0, 8, 9 + 3 * 73]
    assert merkle.veb_address(4, 8 ** 4 - 1, 5) == 9 + 64 * 73 - 1


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        row = out[-1]
        out.append([sha("".join(row[i:i + 8])) for i in range(0, len(row), 8)])
    return out


def proof_of(levels, at):
    out = []
    for row in levels[:-1]:
        start = at - at % 8
        out.append((at - start, [x for j, x in enumerate(row[start:start + 8]) if j != at - start]))
        at //= 8
    return out


def manifest_by_brute_force(rows, tampered):
    def leaf(r, text):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[1], r[2], r[3], text)))
    groups = collections.defaultdict(list)
    for r in rows:
        low = r[4].translate({c: c + 32 for c in range(65, 91)}) if r[4] else r[4]
        groups[r[2]].append((r[0] is None, r[0] or 0, leaf(r, r[4]), leaf(r, low) if tampered(r[0]) else leaf(r, r[4])))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels_of([x[2] for x in sorted(groups[g])]) for g in langs}
    top = levels_of([trees[g][-1][0] for g in langs])
    out = []
    for k, g in enumerate(langs):
        for at, (nameless, i, h, claimed) in enumerate(sorted(groups[g])):
            path = proof_of(trees[g], at) + proof_of(top, k)
            cur = claimed
            for place, siblings in path:
                cur = sha("".join(siblings[:place] + [cur] + siblings[place:]))
            out.append((None if nameless else i, h, trees[g][-1][0], top[-1][0],
                        sha("".join(s for _, ss in path for s in ss)), cur, cur == top[-1][0]))
    return sorted(out, key=str)


def third(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0


@pytest.mark.parametrize("case", ["many", "langs", "one", "odd"])
def test_manifest_equals_brute_force(spark, case):
    rng = random.Random(9)
    if case == "many":  # two rounds of blocks, with a last block of one leaf
        rows = [(i, "s", "en", i, f"Text {i}") for i in range(4097)] + [(9000 + i, None, "ör", None, "B") for i in range(65)]
    elif case == "langs":
        rows = [(i, "s", rng.choice([None, "", "Z", "a", "é", "zz", *map(str, range(20))]), i, "Abc") for i in range(300)]
    elif case == "one":
        rows = [(5, "s", None, None, None)]
    else:
        rows = [(1, None, "en", 3, None), (1, None, "en", 3, None), (1, "x", "en", 3, "É A"), (None, "x", "en", None, "A"),
                (None, "x", "en", None, "B"), (-3, "x", "en", 1, ""), (7, "x", "fr", 1, "É" * 100_000 + "A" * 100_000),
                (2 ** 62, "1:a", "fr", 1, "tab\t"), (12, "-", "fr", 1, "-")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    df = df.withColumn("grp", F.lit(1)).withColumn("pos", F.lit("clash")).repartition(5)
    got = sorted((tuple(r) for r in merkle.document_proofs(df, held_out(3, 0)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)
    assert got == manifest_by_brute_force(rows, third)


def test_manifest_of_an_empty_table_and_its_files(spark, tmp_path):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    assert merkle.document_proofs(spark.createDataFrame([], schema), F.lit(True)).count() == 0
    rows = spark.createDataFrame([(i, "s", "en", 1, "x") for i in range(20)], schema)
    m = merkle.build_manifest(rows.select("lang", "doc_id", merkle.leaf_digest("text").alias("digest")), "lang", ["doc_id"])
    m.write(str(tmp_path / "m"))
    stored = spark.read.parquet(str(tmp_path / "m" / "blocks"))
    assert sorted((r.tree, r.size) for r in stored.collect()) == [("groups", 1), ("rows", 20)]
