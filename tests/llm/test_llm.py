"""The training-data operators against brute force, on small fixtures."""
import collections
import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelake.llm import near_dup, sharding, url_filter
from carelake.llm.decontaminate import contamination, decontaminate
from carelake.llm.near_dup import near_duplicates, parity
from carelake.llm.pii import pseudonymise
from carelake.llm.quality import quality_scores
from carelake.llm.queries import held_out, sentencepiece_model
from carelake.llm.sentencepiece_codec import Codec, decode, encode
from carelake.llm.shingles import shingle_set, word_hashes
from carelake.llm.token_count import LongestMatch, sentencepiece_vocabulary, token_counts
from carelake.llm.topk import top_k
from carelake.llm.toxicity import grammar, toxicity_scores

WORDS = "the of and to in it is on by with from that erth thon hean ble stion are was for he an".split()


def text_of(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "x", "ing", str(rng.randint(0, 99))]) for _ in range(n))


def odd_docs(spark, extra=()):
    """Nulls, empty and blank texts, ties, repeated rows and clashing columns."""
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (None, "one two three four five six"), (5, "a b c d e f g"),
            (5, "a b c d e f g"), (6, "A b C d e f g"), *extra]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(7)).withColumn(
        "id", F.lit("x")).withColumn("score", F.lit(None).cast("double"))


def near_dup_by_brute_force(docs, k):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("k,lane", [(2, near_dup.LANE), (5, near_dup.LANE), (2, 1), (3, 2)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, k, lane):
    monkeypatch.setattr(near_dup, "LANE", lane)
    rng = random.Random(k)
    docs = []
    for g in range(12):  # clouds of mutated copies around the threshold
        base = text_of(rng, rng.choice([4, 8, 40, 150])).split()
        for _ in range(rng.choice([1, 4, 12])):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 12))):
                w[rng.randrange(len(w))] = rng.choice(WORDS)
            docs.append((len(docs), " ".join(w)))
    docs += [(len(docs), ""), (len(docs) + 1, None), (len(docs) + 2, "single")]
    want = near_dup_by_brute_force(docs, k)
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), shingle_words=k).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_across_lanes(spark, monkeypatch):
    """Links between members of a cloud of near misses: nearly every bucket
    they share is headed by another document, so only the second comparison,
    here in lanes of three rows, finds them."""
    seen, real = [], near_dup._verified
    monkeypatch.setattr(near_dup, "LANE", 3)
    monkeypatch.setattr(near_dup, "_verified", lambda pairs, *a: seen.append(pairs.count()) or real(pairs, *a))
    rng = random.Random(9)
    base = [f"w{i}" for i in range(100)]

    def changed(words, n, mark):
        words = list(words)
        for j in rng.sample(range(100), n):
            words[j] = f"{mark}x{j}"
        return words
    clouds = [changed(base, 6 if i < 100 else 2, i) for i in range(110)]  # only the last ten link
    docs = [(i, " ".join(w)) for i, w in enumerate(clouds)]
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), shingle_words=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == near_dup_by_brute_force(docs, 2)
    assert len(seen) == 2 and seen[1] >= 10


def test_near_duplicates_odd_rows(spark):
    got = near_duplicates(odd_docs(spark), shingle_words=2).collect()
    assert len(got) == 8
    by = {r.doc_id: r for r in got}
    assert by[1].n_shingles == by[2].n_shingles == by[3].n_shingles == 0 and by[2].kept
    assert by[6].component_id == 5 and not by[6].kept
    assert by[None].component_id is None and by[None].kept
    assert near_duplicates(odd_docs(spark).limit(0)).count() == 0


def test_parity_never_exceeds_the_difference():
    rng = random.Random(3)
    for n in (1, 10, 400, 5000):
        a = shingle_set(word_hashes(text_of(rng, n).encode()), 2)
        b = shingle_set(word_hashes(text_of(rng, n).encode()), 2)
        bits = sum(int(x).bit_count() for x in (parity(a) ^ parity(b)).view(np.uint64))
        assert bits <= len(np.setxor1d(a, b))


def test_long_text_hashes_like_its_words():
    text = " ".join(f"w{i % 977}" for i in range(200_000))
    assert len(word_hashes(text.encode())) == 200_000
    assert (word_hashes(text.encode())[:977] == word_hashes(" ".join(f"w{i}" for i in range(977)).encode())).all()


def test_shards_equal_brute_force(spark):
    table = sharding.fill_table(sharding.SHARDS)
    share = collections.Counter(table)
    assert len(table) == sharding.SLOTS and max(share.values()) - min(share.values()) <= 1
    fewer = sharding.fill_table(sharding.SHARDS[:-1])
    assert sum(a == b for a, b in zip(table, fewer)) > 0.75 * len(table)
    got = sharding.assign_shards(odd_docs(spark))
    assert got.count() == 8 and {"id", "n", "score"} <= set(got.columns)
    assert all(r.shard == table[r.slot] for r in got.collect())
    with pytest.raises(ValueError):
        sharding.fill_table(["a", "b"], 100)


def test_url_rules_equal_brute_force(spark):
    urls = ["http://a.com/x", "https://EXAMPLE.com/en/1?q", "http://www.example.com/en/", "http://b.www.example.com/en/z#a",
            "http://x.net/es/1", "http://net/fr/", "http://x.net/de/1", "http://a.com", "nourl", None, "", "http://com/",
            "http://notexample.com/en/1", "a://b.com://c/d", "http://h.org/p://q/"]
    rows = [(i, u, None) for i, u in enumerate(urls * 3)]
    got = {r.page_id: r for r in url_filter.filter_urls(
        spark.createDataFrame(rows, "page_id long, url string, host string")).collect()}
    assert len(got) == len(rows)
    for i, u, _ in rows:
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host):])[0]
        host, best = host.lower(), None
        for rule, verdict in url_filter.RULES:
            h, p = rule.split("/", 1)
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
                best = rule, verdict
        assert (got[i].host, got[i].path) == (host, path), u
        assert (got[i].rule, got[i].verdict) == best if best else got[i].rule is None and got[i].verdict in ("allow", "block")
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_suffixes_are_counted_beyond_the_sample(spark, monkeypatch):
    """Verdicts that rest on suffixes don't depend on the size of the fit's sample."""
    rules = (("bad.com/", "block"), ("good.com/", "allow"), ("org/", "allow"))
    urls = [f"http://{h}/{i}" for i in range(150) for h in ("bad.com", "x.good.com", f"s{i}.org", f"t{i}.bad.com")]
    df = spark.createDataFrame([(i, u) for i, u in enumerate([*urls, "ftp://bad.com.evil.net/x"])], "page_id long, url string")
    from carelake.llm.url_filter import _suffix, host_of
    whole = {r.page_id: r.verdict for r in url_filter.filter_urls(df, rules=rules).collect()}
    monkeypatch.setattr(url_filter, "TRAIN_ROWS", 60)
    cut = {r.page_id: r.verdict for r in url_filter.filter_urls(df, rules=rules).collect()}
    assert whole == cut and len(cut) == len(urls) + 1
    assert df.select(host_of(F.col("url")).alias("host")).select(_suffix()).distinct().count() > 150


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    v = [(int(i), [int(x) for x in rng.integers(-40, 40, 6)]) for i in range(300)]
    v += [(300 + i, [30, 1, 2, 3, 4, 5]) for i in range(60)] + [(400, None), (401, [1, None]), (None, [1, 2]), (402, [9]), (402, [9])]
    df = spark.createDataFrame([(a, b, "x") for a, b in v], "vec_id long, v array<long>, score string")
    got = {}
    for r in top_k(df, df.where("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    fine = {a: b for a, b in v if a is not None and b is not None and None not in b}
    for q in (i for i in fine if i % 50 == 0):
        s = sorted((-sum(x * y for x, y in zip(fine[q], c)), i) for i, c in fine.items() if i != q)[:5]
        assert sorted(got[q]) == [(n + 1, i, -p) for n, (p, i) in enumerate(s)]
    assert top_k(df.limit(0), df.limit(0)).count() == 0


def test_top_k_of_one_id_with_many_vectors(spark, monkeypatch):
    from carelake.llm import topk
    monkeypatch.setattr(topk, "BLOCK", 4)
    sign = [(7, [a * 3, b * 4, c * 5]) for a in (1, -1) for b in (1, -1) for c in (1, -1)]  # equal lengths, several blocks
    df = spark.createDataFrame([*sign, *((i, [i % 3, 1, 0]) for i in range(20, 40))], "vec_id long, v array<long>")
    got = [(r.vec_id, r.score) for r in topk.top_k(df, df.where("vec_id = 20"), k=30).orderBy("rank").collect()]
    want = sorted([(i, 2 * (i % 3) + 1) for i in range(21, 40)] + [(7, 2 * v[0] + v[1]) for _, v in sign], key=lambda x: (-x[1], x[0]))
    assert sorted(got) == sorted(want) and [s for _, s in got] == [s for _, s in want]


@pytest.mark.parametrize("q_bytes,v_bytes,q_blocks,tasks", [(0, 0, 0, 8), (1, 10 ** 12, 1, 2000), (2 * 10 ** 10, 10 ** 12, 10 ** 5, 2000),
                                                            (10 ** 9, 10 ** 3, 5000, 16)])
def test_top_k_grid(q_bytes, v_bytes, q_blocks, tasks):
    from carelake.llm import topk
    groups, lanes = topk._grid(q_bytes, v_bytes, q_blocks, tasks)
    assert groups >= 1 and lanes >= 1 and groups * lanes >= tasks and q_bytes <= groups * topk.HELD


def test_top_k_of_vectors_without_components(spark):
    df = spark.createDataFrame([(i, []) for i in range(0, 150, 25)] + [(151, [3, -1])], "vec_id long, v array<long>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in top_k(df, df.where("vec_id % 50 = 0"), k=3).collect())
    assert got == [(q, n + 1, i, 0) for q in (0, 50, 100) for n, i in enumerate(
        sorted({0, 25, 50, 75, 100, 125, 151} - {q})[:3])]
    bare = df.where("vec_id < 150")
    assert top_k(bare, bare.where("vec_id = 0")).count() == 5


def test_top_k_prunes_keep_concentrated_answers(spark, monkeypatch):
    from carelake.llm import topk
    q, c = np.array([[100, 10, 5, 3]]), np.array([[95, 10, 5, 3], [70, 60, 30, 20], [60, 50, 50, 40]])
    for bound, want in ((7500.0, {1: 9634, 2: 7810}), (9000.0, {1: 9634})):
        _, ids, scores = topk._search_block(q, np.array([0]), np.array([bound]), c, np.array([1, 2, 3]), 5)
        assert {i: s for i, s in zip(ids.tolist(), scores.tolist()) if s >= bound} == want
    rng, pruned = np.random.default_rng(6), []
    for _ in range(300):  # directions in the cap stay in the range, and reach its ends
        x = rng.normal(size=(2000, 3))
        x /= np.sqrt((x ** 2).sum(axis=1))[:, None]
        t = rng.uniform(0.6, 0.95)
        near, (least, most) = x[x @ x[0] >= t], topk._cap_range(x[0, 0], t)
        assert least - 1e-9 <= near[:, 0].min() and near[:, 0].max() <= most + 1e-9
        pruned.append(((x[:, 0] < least) | (x[:, 0] > most)).mean())
    assert np.mean(pruned) > 0.2
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 8)
    monkeypatch.setattr(topk, "PER_PARTITION", 64)
    monkeypatch.setattr(topk, "HELD", 600)  # several groups of query blocks
    v = []
    for i in range(400):
        x = rng.integers(-12, 12, 5)
        x[rng.integers(0, 5)] = rng.choice([-1, 1]) * rng.integers(60, 120)
        v.append((i, [int(c) for c in x]))
    df = spark.createDataFrame(v, "vec_id long, v array<long>")
    got = {}
    for r in topk.top_k(df, df.where("vec_id % 10 = 0")).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in range(0, 400, 10):
        s = sorted((-sum(x * y for x, y in zip(v[q][1], c)), i) for i, c in v if i != q)[:5]
        assert sorted(got[q]) == [(n + 1, i, -p) for n, (p, i) in enumerate(s)]


def test_token_counts_equal_greedy_splitting(spark):
    vocabulary = sentencepiece_vocabulary(sentencepiece_model())
    have = set(vocabulary)

    def greedy(word):
        at = n = 0
        while at < len(word):
            for to in range(len(word), at, -1):
                if ("##" if at else "") + word[at:to] in have:
                    break
            else:
                return 0
            at, n = to, n + 1
        return n
    count, rng = LongestMatch(vocabulary).count, random.Random(1)
    words = ["".join(rng.choice("abcdeéñßthx漢1_") for _ in range(rng.randint(1, 14))) for _ in range(4000)]
    assert [count(w) for w in words] == [greedy(w) for w in words]
    small = LongestMatch(["abcdx", "a", "b", "c", "##b", "##c", "##cdy", "##dz"])
    assert [small.count(w) for w in ("abcdz", "abcdy", "abcd", "bcdy", "")] == [4, 3, 0, 2, 0]
    got = token_counts(odd_docs(spark, [(9, "x" * 500)]), vocabulary).collect()
    assert len(got) == 9 and next(r for r in got if r.doc_id == 9).n_unknown == 1
    assert next(r for r in got if r.doc_id == 1).n_tokens == 0


def test_token_counts_equal_their_sql(spark):
    import duckdb
    import pandas as pd
    from carelake.llm.token_count import oracle_sql
    vocabulary = sentencepiece_vocabulary(sentencepiece_model())
    texts = [None, "", " \t\n", "it's 'quoted' -- ##ing; a_b __", "Straße 12½ ²x e\u0301 naïve", "a\u00a0b\u2003c\u0085d\x1ce\u200bf",
             "日本語のテキスト और हिन्दी", "x" * 900, "😀😀 ok", "don't stop " * 300]
    rng = random.Random(3)
    texts += ["".join(rng.choice("aeinrst ABß_'7.\u0301中") for _ in range(60)) for _ in range(80)]
    rows = list(enumerate(texts))
    got = token_counts(spark.createDataFrame(rows, "doc_id long, text string"), vocabulary, longest=None)
    c = duckdb.connect()
    c.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"doc_id": "int64", "text": "string"}))
    assert sorted(tuple(r) for r in got.collect()) == sorted(c.execute(oracle_sql(vocabulary)).fetchall())


def test_token_counts_split_long_words(spark, tmp_path):
    from carelake.llm.queries import op4_token_counts
    have, rng = set(sentencepiece_vocabulary(sentencepiece_model())), random.Random(7)
    word = "".join(rng.choice("abcdefghij0123") for _ in range(5000))
    at = n = 0
    while at < len(word):
        at = next(to for to in range(min(len(word), at + 40), at, -1) if ("##" if at else "") + word[at:to] in have)
        n += 1
    spark.createDataFrame([(1, word)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    (row,) = op4_token_counts(spark, str(tmp_path)).collect()
    assert (row.n_words, row.n_tokens, row.n_unknown) == (1, n, 0)


def test_pseudonyms_keep_format_and_link(spark):
    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    rng, cards = random.Random(2), []
    while len(cards) < 60:
        d = "4" + "".join(rng.choice("0123456789") for _ in range(15))
        cards += [d] if luhn(d) else []
    docs = [(i, f"pay {c} now; {c[:4]}-{c[4:8]}-{c[8:12]}-{c[12:]}") for i, c in enumerate(cards)]
    other = ["clean text with 12 numbers and 3.4", "call +1 (988) 555-2485 or 988-555-2485.", "ssn 123-45-6789 not 000-45-6789",
             "a.b1@mail.example.com", "10.20.30.40 and 999.1.1.1", "2020-02-29 31.12.1999 2021-02-30", None, "", "bad 4041894974608796"]
    docs += [(100 + i, t) for i, t in enumerate(other)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_card", F.lit("clash"))
    out = {r.doc_id: r for r in pseudonymise(df, "key").collect()}
    new = [re.findall(r"\d{16}", out[i].text)[0] for i in range(60)]
    assert all(luhn(d) and d[0] == "4" for d in new) and len(set(new)) == 60 and not set(new) & set(cards)
    assert all(out[i].text.split("; ")[1].replace("-", "") == new[i] and out[i].n_card == 2 for i in range(60))
    t = {i: out[100 + i].text for i in range(len(other))}
    assert t[0] == other[0] and t[6] is None and t[7] == "" and t[8] == other[8]
    a, b = re.fullmatch(r"call \+1 \((\d{3})\) (\d{3}-\d{4}) or (\d{3}-\d{3}-\d{4})\.", t[1]).groups()[::2]
    assert b.startswith(a) and "988" != a
    assert re.fullmatch(r"ssn \d{3}-\d\d-\d{4} not 000-45-6789", t[2]) and "123-45-6789" not in t[2]
    assert re.fullmatch(r"[a-z]\.[a-z]\d@mail\.example\.com", t[3]) and t[3] != other[3]
    assert re.fullmatch(r"(\d{1,3}\.){3}\d{1,3} and 999\.1\.1\.1", t[4]) and t[4] != other[4]
    assert t[5].endswith(" 2021-02-30") and "2020-02-29" not in t[5]
    again = {r.doc_id: r.text for r in pseudonymise(df, "key").collect()}
    assert again == {i: r.text for i, r in out.items()} and pseudonymise(df.limit(0), "key").count() == 0


def test_pseudonyms_of_long_runs(spark):
    """Long hosts and runs neither overflow the stack nor take quadratic time."""
    host = "a@b" + ".c" * 2000 + ".com"
    run = "x1" * 500_000
    texts = [host, "1234 " + run, "@" * 100_000 + "1234", "a@" * 50_000, "x" * 64 + "@mail.com", "x" * 65 + "@mail.com",
             "a@" + "b" * 63 + ".com", "a@" + "b" * 64 + ".com", "+1 (988) 555-2485ab@mail.com", "1.2.3.4a@b.com"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    start = time.time()
    out = [r.text for r in pseudonymise(df, "key").orderBy("doc_id").collect()]
    assert time.time() - start < 60
    same = [a == b for a, b in zip(texts, out, strict=True)]
    assert same == [True, True, True, True, False, True, False, True, False, False]
    assert "ab@mail.com" not in out[8] and "555-2485" not in out[8] and out[8].endswith("@mail.com")
    with pytest.raises(ValueError):
        pseudonymise(df, "")


def test_numbers_come_back_by_the_inverse_network(spark):
    from carelake.llm.pii import feistel
    v = spark.range(487 * 75).select(F.col("id"), F.lit(75).alias("a"), F.lit(487).alias("b"))
    there = v.withColumn("p", feistel(F.col("id"), F.col("a"), F.col("b"), F.lit("k"), F.lit("t")))
    back = there.withColumn("q", feistel(F.col("p"), F.col("a"), F.col("b"), F.lit("k"), F.lit("t"), undo=True))
    n = back.agg(F.count_distinct("p"), F.min("p"), F.max("p"), F.sum((F.col("q") != F.col("id")).cast("int"))).first()
    assert tuple(n) == (487 * 75, 0, 487 * 75 - 1, 0)


def test_decontamination_finds_substituted_passages(spark):
    rng = random.Random(4)
    items = [(i, text_of(rng, 30)) for i in range(5)] + [(9, None), (10, "two words")]
    swapped = items[0][1].split()
    for j in range(4, 30, 6):
        swapped[j] = "zzz"
    docs = [(0, text_of(rng, 50) + " " + items[1][1].upper() + " " + text_of(rng, 9)), (1, " ".join(swapped)), (2, text_of(rng, 300)),
            (3, " ".join(items[2][1].split()[:6])), (4, None), (5, ""), (None, items[1][1]), (0, "again")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in contamination(df, bench).collect()} == {(0, 1), (1, 0)}
    left = decontaminate(df, bench)
    assert left.columns == df.columns and sorted(r.doc_id for r in left.where("doc_id IS NOT NULL").collect()) == [2, 3, 4, 5]
    assert left.where("doc_id IS NULL").count() == 1
    assert contamination(df, bench.limit(0)).count() == 0


def test_decontamination_of_short_items_equals_brute_force(spark):
    from itertools import combinations
    items, docs = [], []
    for n in range(1, 14):
        words = [f"w{n}x{j}" for j in range(n)]
        items.append((n, " ".join(words)))
        for k in range(n // 5 + 2):
            for gone in list(combinations(range(n), k))[:60 if k > n // 5 else None]:
                w = ["zzz" if j in gone else x for j, x in enumerate(words)]
                docs += [(len(docs), " ".join(w)), (len(docs) + 1, " ".join(["pre", *w, "post"]))]
        docs += [(len(docs), " ".join(words[1:])), (len(docs) + 1, " ".join(words[:-1]))]
    want, of = {}, {n: t.split() for n, t in items}
    for i, text in docs:
        w = text.split()
        for n, x in of.items():
            same = [sum(0 <= s + j < len(w) and w[s + j] == x[j] for j in range(n)) for s in range(-n, max(1, len(w)))]
            if 100 * max(same) >= 80 * n:
                want[i, n] = max(same)
    got = contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id): r.matched_words for r in got.collect()} == want


def test_codec_has_parity_with_the_library(spark):
    import sentencepiece
    model = sentencepiece_model()
    sp, codec, rng = sentencepiece.SentencePieceProcessor(model_proto=model), Codec(model), random.Random(6)
    texts = ["", " ", "  ", "a", " a", "a  b", "x" + " " * 37 + "y", "\n\t tab", "漢字 é ß ñ 🙂", "<s> </s> <0x41>", " " * 15, "   lead",
             "trail   ", "a ▁b", text_of(rng, 60_000)]
    texts += ["".join(rng.choice("ab é▁ \n1.") for _ in range(rng.randint(1, 60))) for _ in range(500)]
    ids = codec.encode(texts)
    assert ids == sp.encode(texts) and codec.decode(ids) == [sp.decode(x) for x in ids]
    rows = odd_docs(spark, [(11, t) for t in texts[5:9]])
    got = encode(rows, model)
    assert got.count() == rows.count() and got.where("doc_id = 1").first().ids is None
    assert sorted(t or "" for (t,) in decode(got, model).select("text").collect()) == sorted(t or "" for (t,) in rows.select("text").collect())


def test_unigram_models_are_rebuilt():
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    proto.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    proto.normalizer_spec.add_dummy_prefix, proto.normalizer_spec.remove_extra_whitespaces = True, False
    for piece, score, kind in [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3), ("▁", -2, 1), ("a", -3, 1), ("b", -3.3, 1), ("ab", -4.1, 1),
                               ("▁ab", -5.5, 1), ("ba", -5.7, 1), ("▁a", -4.2, 1)]:
        proto.pieces.add(piece=piece, score=score, type=kind)
    model = proto.SerializeToString()
    sp, codec, rng = sentencepiece.SentencePieceProcessor(model_proto=model), Codec(model), random.Random(8)
    texts = ["".join(rng.choice("ab ") for _ in range(rng.randint(1, 20))) for _ in range(200)]
    assert codec.encode(texts) == sp.encode(texts)


def labelled(spark, make_good, make_bad, n=240):
    rng = random.Random(9)
    rows = [(i, make_good(rng) if i % 3 else make_bad(rng), int(i % 3 > 0)) for i in range(n)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(None, "x"), (n + 1, None), (n + 2, ""), (n + 2, "")], "doc_id long, text string")
    return docs, spark.createDataFrame([(r[0], r[2], 1 - r[2]) for r in rows], "doc_id long, quality int, toxic int")


def test_quality_ranks_held_out_documents(spark):
    docs, labels = labelled(spark, lambda r: text_of(r, 80) + ".", lambda r: " | ".join(text_of(r, 50).split()))
    got = quality_scores(docs, labels, held_out(3, 1)).collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    out = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in out]) > 0.95
    assert {r.score for r in quality_scores(docs, labels.limit(0), held_out(3, 1)).collect()} == {0.5}


def test_toxicity_grammar_and_scores(spark):
    machine, state, seen = grammar().arcs, 0, []
    for symbol in ("negation", "insult", "other", "other", "target", "insult", "report", "insult"):
        state, out = machine[state, symbol]
        seen.append(out)
    assert seen == ["negation", "insult+negation", "other", "other", "target", "insult+target", "report", "insult+report"]
    docs, labels = labelled(spark, lambda r: text_of(r, 60) + ".", lambda r: text_of(r, 30) + " grumpfx " + text_of(r, 30))
    got = toxicity_scores(docs, labels, held_out(4, 2)).collect()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert len(got) == docs.count() and all(not math.isnan(r.score) and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.predicted == truth[r.doc_id] for r in got if r.held_out and r.doc_id in truth)
    bare = {r.doc_id: r.predicted for r in toxicity_scores(
        spark.createDataFrame([(1, "You are an idiot."), (2, "A fine day.")], "doc_id long, text string"), labels.limit(0), held_out(4, 2)).collect()}
    assert bare == {1: 1, 2: 0}


def rare(spark, make_common, make_rare, doubtful, n=1200):
    """Labelled documents, one in ten of the rare kind; of each kind some are doubtful."""
    rng = random.Random(12)
    rows = [(i, doubtful(rng) if i % 7 == 0 else make_rare(rng) if i % 10 == 0 else make_common(rng), int(i % 10 == 0)) for i in range(n)]
    return (spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"),
            spark.createDataFrame([(r[0], r[2], 1 - r[2]) for r in rows], "doc_id long, toxic int, quality int"))


def test_toxicity_scores_hardly_depend_on_the_sample(spark, monkeypatch):
    from carelake.llm import toxicity
    docs, labels = rare(spark, lambda r: text_of(r, 30) + ".", lambda r: text_of(r, 20) + ". you idiot " + text_of(r, 9),
                        lambda r: text_of(r, 20) + ". it is not stupid " + text_of(r, 9))
    whole = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, labels, F.lit(False)).collect()}
    monkeypatch.setattr(toxicity, "TRAIN_PER_LABEL", 100)
    cut = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, labels, F.lit(False)).collect()}
    apart = max(abs(whole[i] - cut[i]) for i in whole)
    assert apart < 0.1 and all((whole[i] >= 0.3) == (cut[i] >= 0.3) for i in whole), apart


def test_quality_threshold_hardly_depends_on_the_sample(spark, monkeypatch):
    from carelake.llm import quality
    some = lambda r: text_of(r, r.randint(20, 80))
    docs, labels = rare(spark, some, lambda r: text_of(r, r.randint(10, 60)), some)
    whole = [r.predicted for r in quality.quality_scores(docs, labels, F.lit(False)).collect()]
    monkeypatch.setattr(quality, "TRAIN_PER_LABEL", 100)
    cut = [r.predicted for r in quality.quality_scores(docs, labels, F.lit(False)).collect()]
    assert abs(np.mean(whole) - np.mean(cut)) < 0.1


def test_pipeline_stages_keep_columns(spark):
    import corpus_pipeline as p
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    docs = docs.unionByName(docs.limit(1).selectExpr("CAST(NULL AS BIGINT) doc_id", "CAST(NULL AS STRING) text", "lang", "source", "n_chars"))
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        assert out.where("doc_id IS NULL").count() == 1 and out.count() <= docs.count()
    assert p.STAGES[-1][1](spark, docs, sf).count() == docs.count()


def test_pipeline_judges_rows(spark, tmp_path):
    """Rows without an id are judged; of rows that share an id only the guilty go."""
    import corpus_pipeline as p
    rng = random.Random(12)
    clean = [text_of(rng, 60) for _ in range(12)]
    bench = text_of(rng, 30)
    leak = text_of(rng, 20) + " " + bench + " " + text_of(rng, 20)
    toxic = "You are a stupid idiot and I will kill you, you worthless scum. " * 3
    rows = [(i, t) for i, t in enumerate(clean)]
    rows += [(3, toxic), (None, toxic + " again"), (4, leak), (None, leak + " more"), (5, clean[6]), (None, clean[7]), (None, text_of(rng, 50)),
             (20, ""), (20, ""), (None, None), (None, ""), (8, clean[8])]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], schema)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, bench)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))

    def left(stage, df):
        out = stage(spark, df, str(tmp_path))
        assert out.columns == docs.columns
        return collections.Counter((r.doc_id, r.text) for r in out.collect())
    given = collections.Counter(rows)
    calm = given - collections.Counter([(3, toxic), (None, toxic + " again")])
    assert left(p.drop_toxic, docs) == calm
    pure = given - collections.Counter([(4, leak), (None, leak + " more")])
    assert left(p.drop_benchmark_leaks, docs) == pure
    # of clean[6] row 5 stays, of clean[7] row 7, of clean[8] one; the leaks and the toxic texts are groups of their own
    single = given - collections.Counter([(6, clean[6]), (None, clean[7]), (8, clean[8]), (None, leak + " more"), (None, toxic + " again")])
    assert left(p.drop_near_duplicates, docs) == single
    assert p.run(spark, str(tmp_path)).count() == sum((calm & pure & single).values())
    empty = docs.limit(0)
    assert all(stage(spark, empty, str(tmp_path)).count() == 0 for _, stage in p.STAGES)


def test_scores_come_from_all_labelled_documents(spark, monkeypatch):
    """A bound on the labelled documents changes no score."""
    from carelake.llm import quality, toxicity
    some = lambda r: text_of(r, r.randint(20, 80))
    docs, labels = rare(spark, some, lambda r: text_of(r, r.randint(10, 60)) + ". you idiot", some, 400)
    for module, scores in ((quality, quality.quality_scores), (toxicity, toxicity.toxicity_scores)):
        whole = {r.doc_id: r.score for r in scores(docs, labels, F.lit(False)).collect()}
        monkeypatch.setattr(module, "TRAIN_PER_LABEL", 20)
        bound = {r.doc_id: r.score for r in scores(docs, labels, F.lit(False)).collect()}
        assert max(abs(whole[i] - bound[i]) for i in whole) < 1e-9


def test_toxicity_entries_are_counted_without_shuffling_those_of_each_document(spark):
    from carelake.llm import toxicity
    texts = ["The then they, THE a1 grumpfx grumpfx!", "", None, "Überlange Wörter über grumpfy's ab", "then " * 50, "Grumpfx then"]
    want = collections.Counter()
    for t in texts:
        words = {w for w in re.split(r"[^\w']+", (t or "").lower()) if len(w) >= 3 and not re.search("[0-9]", w)}
        want.update({f"{w}$" for w in words} | {w[:k] for w in words for k in range(3, 9) if len(w) > k})
    got = toxicity.entry_counts(spark.createDataFrame([(t,) for t in texts], "text string"))
    assert {r.e: r.n for r in got.collect()} == dict(want)
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert len(re.findall(r"\bExchange\b", plan)) == 1, plan
