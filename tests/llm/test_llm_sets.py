"""Operators over the whole corpus: mixing, packing, line dedup, fingerprints, n-gram join, chat, pipeline."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from veracity.llm import chat, common, fingerprint, graph, jaccard, lines, mixing, packing

W = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, source=lambda i: f"s{(i or 0) % 3}"):
    return spark.createDataFrame([(i, t, "en", source(i), len(t or "")) for i, t in texts], DOCS)


def words(rng, n, alphabet="abcdefgh"):
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(2, 7))) for _ in range(n)]


# components


def union(pairs):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


def test_components(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(500, 600), rng.randrange(500, 600)) for _ in range(60)]
    pairs += [(1000, x) for x in range(1001, 1200)] + [(7, 7), (3, 4), (4, 3)]
    df = spark.createDataFrame(pairs + [(None, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in graph.components(df).collect()}
    assert got == {k: v for k, v in union([p for p in pairs if p[0] != p[1]]).items()}
    assert graph.components(df.limit(0)).count() == 0


# mixing


def water(sizes, weights, cap=3):
    total, left, out = sum(sizes), list(range(len(sizes))), [0.0] * len(sizes)
    rest = float(total)
    while left and rest > 0:
        w = sum(weights[i] for i in left)
        over = [i for i in left if rest * weights[i] / w > cap * sizes[i]]
        if not over:
            for i in left:
                out[i] = rest * weights[i] / w
            break
        for i in over:
            out[i] = float(cap * sizes[i])
        rest = total - sum(out)
        left = [i for i in left if i not in over]
    return out


def test_mixing(spark):
    rng = random.Random(2)
    texts = [(i, " ".join(words(rng, rng.choice([0, 1, 5, 40, 300])))) for i in range(400)]
    texts += [(500, None), (501, ""), (502, "  \n"), (503, "word " * 20000), (7, texts[7][1]), (7, texts[7][1])]
    source = {i: rng.choice(["a", "a", "a", "b", "c", "é", None, "", "z"]) for i, _ in texts}
    df = docs_of(spark, texts, source.get).withColumnRenamed("lang", "size")
    got = mixing.mix(df).collect()
    again = mixing.mix(df.repartition(13)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert len(got) == len(texts)
    size = collections.Counter()
    for i, t in texts:
        size[source[i]] += len(W.findall(t or ""))
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    want = dict(zip(names, water([size[s] for s in names], [i % 3 + 1 for i in range(len(names))]), strict=True))
    taken = collections.Counter()
    for r in got:
        assert r["source_size"] == size[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in names:
        assert taken[s] == pytest.approx(want[s], rel=0.03, abs=5)
    assert mixing.mix(df.limit(0)).count() == 0


def test_schedule(spark):
    sized = spark.createDataFrame([("a", 50_000), ("b", 100_000), ("c", 1_000)], "source string, size long")
    tgt = mixing.targets(sized)
    spec = mixing.blocks(tgt)
    s = mixing.schedule(spec).toPandas()
    info = {r["rank"]: r for r in spec.collect()}
    assert sorted(s["slot"].tolist()) == s["slot"].drop_duplicates().sort_values().tolist()
    for rank, g in s.groupby("rank"):
        g = g.sort_values("slot")
        assert g["n"].tolist() == list(range(len(g)))
        assert (g["block"] == g["n"] % info[rank]["n_blocks"]).all()
        # low discrepancy: every prefix of the schedule is near its share
        share = (info[rank]["hi"] - info[rank]["lo"]) / mixing.SPAN
        assert (np.abs(g["slot"].to_numpy() * share - g["n"].to_numpy()) < 4).all()


# packing


def ids_of(text):
    from tokenizers import Tokenizer

    tok = ids_of.tok = getattr(ids_of, "tok", None) or Tokenizer.from_file(packing.default_vocabulary())
    return tok.encode(text or "", add_special_tokens=False).ids


ODD = [None, "", " ", "  two  spaces", "a\n b \tc", "é😀 漢字 x", "<|endoftext|>", "a <|endoftext|>b <|endoftext|> c", "don't I'LL  x",
       "nbsp  x  y", "\x85 z", "tail ", " head", "\x00 \x1f q", "a" * 3000, "word " * 5000, "x​ y"]


def test_encoder_equals_tokenizer():
    rng = random.Random(4)
    texts = [t or "" for t in ODD] + ["".join(rng.choice("ab 1.\n\t'é ") for _ in range(rng.randrange(60))) for _ in range(400)]
    ids, n = packing.encoder(packing.default_vocabulary())(pa.array(texts))
    at = 0
    for t, k in zip(texts, n.tolist(), strict=True):
        assert ids[at:at + k].tolist() == ids_of(t), repr(t)
        at += k


def test_packing(spark):
    rng = random.Random(5)
    texts = list(enumerate(ODD + [" ".join(words(rng, rng.randrange(1, 500))) for _ in range(150)]))
    texts += [texts[3], texts[3]]
    got = packing.pack(packing.pieces(docs_of(spark, texts))).collect()
    by = collections.defaultdict(list)
    seqs = collections.defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, t in dict(texts).items():
        ids = ids_of(t) + [2]
        rows = {r["piece"]: r for r in by[i]}
        assert len(by[i]) == len(rows) * (3 if i == 3 else 1)
        at = 0
        for p in range(len(rows)):
            r = rows[p]
            part = ids[r["start"]:r["start"] + r["length"]]
            assert r["start"] == at and (r["length"] == 1024 or p == 0)
            assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    for items in seqs.values():
        at = 0
        for o, k in sorted(items):
            assert o == at
            at += k
        assert at <= 1024
    total = sum(r["length"] for r in got)
    assert len(seqs) <= math.ceil(total / 1024) * 1.1 + 2
    assert packing.pack(packing.pieces(docs_of(spark, texts).limit(0))).count() == 0


def test_plan_against_bounds():
    rng = random.Random(6)
    for _ in range(30):
        cap = rng.choice([10, 64, 1024])
        counts = collections.Counter(rng.randrange(1, cap + 1) for _ in range(rng.randrange(1, 400)))
        bins = collections.defaultdict(list)
        for length, lo, hi, first, copies, offset in packing.plan(dict(counts), cap):
            for r in range(lo, hi):
                bins[first + (r - lo) // copies].append((offset + (r - lo) % copies * length, length))
        assert sum(map(len, bins.values())) == sum(counts.values())
        for items in bins.values():
            at = 0
            for o, k in sorted(items):
                assert o == at
                at += k
            assert at <= cap
            assert sum(3 * k > cap for _, k in items) <= 2
        least = max(math.ceil(sum(k * v for k, v in counts.items()) / cap), sum(v for k, v in counts.items() if 2 * k > cap))
        assert len(bins) <= least * 1.25 + 1


# line dedup


def line_sets(t):
    return [(i, x.strip(" \t\x0b\x0c\r")) for i, x in enumerate((t or "").split("\n")) if x.strip(" \t\x0b\x0c\r")]


def grams(x, n=5):
    return {x[i:i + n] for i in range(len(x) - n + 1)} or {x}


def test_line_dedup(spark):
    rng = random.Random(7)
    base = [" ".join(words(rng, rng.randrange(3, 60), "abcdefghijklmnop")) for _ in range(150)]

    def edit(x):
        w = x.split(" ")
        w[rng.randrange(len(w))] = words(rng, 1)[0]
        return " ".join(w)

    pool = base + [edit(rng.choice(base)) for _ in range(150)] + ["漢字" * 30, "漢字" * 30 + "x", "a", "b", " a "]
    texts = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 8)))) for i in range(120)]
    texts += [(200, None), (201, ""), (202, "\n \n"), (203, "a\na\na"), (3, texts[3][1]), (204, "x " * 30000)]
    df = docs_of(spark, texts).withColumnRenamed("lang", "line")
    got = lines.dedup(df).collect()
    assert len(got) == len(texts)
    # brute force over the distinct lines
    every = sorted({(d, n, x) for d, t in texts for n, x in line_sets(t)})
    first = {}
    for d, n, x in every:
        first.setdefault(x, (d, n))
    pairs = [(first[a], first[b]) for a, b in itertools.combinations(first, 2)
             if 100 * len(grams(a) & grams(b)) >= 75 * len(grams(a) | grams(b))]
    root = union(pairs)
    want = {(d, n): root.get(first[x], first[x]) for d, n, x in every}
    seen = {}
    for r in got:
        assert r["n_lines"] == len(line_sets(dict(texts)[r["doc_id"]]))
        assert r["n_kept"] == r["n_lines"] - len(r["dropped"])
        for x in r["dropped"]:
            seen[r["doc_id"], x["line_no"]] = (x["keep_doc_id"], x["keep_line_no"])
    dropped = {k: v for k, v in want.items() if k != v}
    assert all(want[k] == want[v] for k, v in seen.items())  # nothing merged that is not linked
    assert len(set(dropped) - set(seen)) <= 0.02 * len(dropped)
    out = {r["doc_id"]: r for r in lines.rewrite(df, lines.dedup(df)).collect()}
    assert out[200]["text"] is None and out[202]["text"] == "\n \n" and list(out[200].asDict()) == df.columns
    alive = [x for r in out.values() for _, x in line_sets(r["text"]) if r["doc_id"] != 3]
    assert len(alive) == len(set(alive))
    assert all(r["n_chars"] == len(r["text"] or "") for r in out.values())
    assert lines.dedup(df.limit(0)).count() == 0


def classes(spark, text):
    """Line to the place of the line that stands for it, of one text without repeated lines."""
    at = text.split("\n")
    drop = lines.dedup(docs_of(spark, [(1, text)])).first()["dropped"]
    to = {x["line_no"]: x["keep_line_no"] for x in drop}
    return {x: to.get(i, i) for i, x in enumerate(at)}


def test_line_dedup_of_templates(spark):
    rng = random.Random(3)
    head = " ".join(words(rng, 20, "abcdefghijklmnop"))
    at = []
    for _ in range(300):
        a = words(rng, 10, "abcdefghijklmnop")
        b = list(a)
        b[rng.randrange(10)] = words(rng, 1)[0]
        at += [f"{head} {' '.join(a)}", f"{head} {' '.join(b)}"]
    at += [f"Posted on 2021-{i:05d} by {words(rng, 1)[0]}" for i in range(200)]
    at = list(dict.fromkeys(at))
    rng.shuffle(at)
    root = classes(spark, "\n".join(at))
    df = spark.createDataFrame([(x,) for x in at], "line string")
    keys = {r["line"]: set(r["keys"]) for r in lines.signed(df).collect()}
    sets = {x: grams(x) for x in at}
    links = [(a, b) for a, b in itertools.combinations(at, 2) if keys[a] & keys[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert len(links) > 250
    assert [(a, b) for a, b in links if root[a] != root[b]] == []


def test_line_dedup_of_short_lines(spark):
    at = ["Read more", "Read more.", "Share this", "Share this!", "Contact us", "Contact us.", "Subscribe", "Subscribe!",
          "Reply", "Reply all now", "- - - -", "- " * 80 + "-"]
    root = classes(spark, "\n".join(at))
    for i in (0, 2, 4, 6, 10):
        assert root[at[i + 1]] == root[at[i]] == i
    assert root["Reply"] != root["Reply all now"]
    rng = random.Random(4)
    short = ["".join(rng.choice("abc ") for _ in range(rng.randrange(5, 20))).strip() for _ in range(400)]
    short += [x + c for x in short for c in "!x"]
    short = sorted({x for x in short if x})
    df = spark.createDataFrame([(x,) for x in short], "line string")
    keys = {r["line"]: set(r["keys"]) for r in lines.signed(df).collect()}
    sets = {x: grams(x) for x in short}
    for a, b in itertools.combinations(short, 2):
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and min(len(sets[a]), len(sets[b])) <= 15:
            assert keys[a] & keys[b], (a, b)


# fingerprints


def brute_winnow(selected_hashes, window):
    out = []
    n = len(selected_hashes)
    for i in range(max(1, n - window + 1)):
        part = selected_hashes[i:i + window]
        low = min(part)
        at = i + max(j for j, h in enumerate(part) if h == low)
        if not out or out[-1][1] != at:
            out.append((low, at))
    return out


def test_winnowing(spark):
    from pyspark.sql import functions as F

    rng = random.Random(8)
    texts = [None, "", " ", "a", "ab cd", "漢字テスト" * 5, "and " * 50, "é😀x" * 20] + [" ".join(words(rng, rng.randrange(1, 200))) for _ in range(40)]
    df = docs_of(spark, list(enumerate(texts)))
    unit = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(fingerprint.UNIT), F.lit(0))
    rows = df.select("doc_id", unit.alias("u"), fingerprint.printed(fingerprint.winnow(F.coalesce("text", F.lit("")))).alias("p")).collect()
    flat = spark.createDataFrame([(r["doc_id"], i, r["u"][i:i + 4]) for r in rows for i in range(max(1, len(r["u"]) - 3)) if r["u"]],
                                 "doc_id long, at int, g array<string>")
    pick = [F.get("g", F.lit(j)) for j in range(4)]
    hashes = collections.defaultdict(list)
    for r in flat.select("doc_id", "at", F.shiftright(F.xxhash64(*pick).bitwiseAND(F.lit(0x7FFFFFFF << 32)), 32).alias("h")).orderBy("doc_id", "at").collect():
        hashes[r["doc_id"]].append(r["h"])
    for r in rows:
        want = " ".join(f"{h:X}:{at}" for h, at in brute_winnow(hashes[r["doc_id"]], fingerprint.WINDOW)) if hashes[r["doc_id"]] else ""
        assert r["p"] == want


def test_fingerprints(spark):
    rng = random.Random(9)
    texts = [(i * 3, " ".join(words(rng, rng.randrange(1, 150)))) for i in range(90)]
    texts += [(500, None), (501, ""), (502, "x"), (503, texts[5][1]), (504, texts[5][1]), (600, "😀é" * 50)]
    df = docs_of(spark, texts)
    old = fingerprint.in_blocks
    try:
        for rows_per_block in (2000, 7):
            fingerprint.in_blocks = lambda d, n=rows_per_block: old(d, n)
            got = {r["doc_id"]: r for r in fingerprint.fingerprints(df).collect()}
            assert len(got) == len(texts)
            for (i, a), (j, b) in zip(texts, texts[1:] + texts[:1], strict=True):
                a, b = a or "", b or ""
                half = len(a) // 2
                edited = a[:len(a) - half] + b[:half]
                r = got[i]
                assert r["n_chars"] == len(a) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
                own, nxt = ({x.split(":")[0] for x in got[k]["fingerprint"].split()} for k in (i, j))
                ed = {x.split(":")[0] for x in r["edited_fingerprint"].split()}
                assert r["near_next"] == pytest.approx(len(own & nxt) / len(own | nxt) if own | nxt else 1.0)
                assert r["near_edited"] == pytest.approx(len(own & ed) / len(own | ed) if own | ed else 1.0)
            assert got[503]["near_next"] == 1.0 and got[503]["fingerprint"] == got[15]["fingerprint"]
    finally:
        fingerprint.in_blocks = old
    one = fingerprint.fingerprints(df.where("doc_id = 0")).first()
    assert one["near_next"] == 1.0
    assert fingerprint.fingerprints(df.limit(0)).count() == 0
    twice = docs_of(spark, [(1, "a b c"), (1, "a b c"), (2, "d e f"), (None, "g")])
    assert fingerprint.fingerprints(twice).count() == 4


# n-gram join


def word_sets(t):
    w = W.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


@pytest.mark.parametrize(("part_size", "keys"), [(512, 1_000_000), (6, 1_000_000), (6, 0)])
def test_jaccard(spark, monkeypatch, part_size, keys):
    monkeypatch.setattr(jaccard, "BROADCAST_KEYS", keys)
    rng = random.Random(10)
    passage = words(rng, 60)
    texts = []
    for i in range(40):
        base = words(rng, rng.randrange(3, 120))
        texts.append(base)
        for _ in range(rng.randrange(0, 5)):
            w = list(base)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = words(rng, 1)[0]
            texts.append(w)
    texts += [passage + words(rng, rng.randrange(0, 40)) for _ in range(40)]
    group = words(rng, 100)
    for _ in range(60):
        w = list(group)
        for _ in range(rng.randrange(0, 3)):
            w[rng.randrange(100)] = words(rng, 1)[0]
        texts.append(w)
    rows = [(i * 2, " ".join(w)) for i, w in enumerate(texts)]
    rows += [(900, None), (901, ""), (902, " \n"), (903, "One two"), (904, "one TWO"), (905, "two one"), (906, "É one"), (907, "é one"),
             (0, rows[0][1]), (908, "z " * 20000)]
    df = docs_of(spark, rows).withColumnRenamed("lang", "node")
    got = jaccard.join(df, part_size=part_size).collect()
    sets = {i: word_sets(t) for i, t in rows}
    pairs = [(a, b) for a, b in itertools.combinations(sets, 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = union(pairs)
    assert len(got) == len(rows)
    for r in got:
        assert r["n_shingles"] == len(sets[r["doc_id"]])
        assert r["component_id"] == root.get(r["doc_id"], r["doc_id"]), r["doc_id"]
    assert jaccard.join(df.limit(0)).count() == 0


# chat


def cheapest(roles):
    """Least cost by search over all labellings and insertions."""
    best = {(chat.START, 0): 0}
    todo = [(0, chat.START, 0)]
    import heapq

    while todo:
        c, s, i = heapq.heappop(todo)
        if best.get((s, i), 1 << 60) < c:
            continue
        if i == len(roles) and s == chat.ASSISTANT:
            return c
        moves = [(c + chat.INSERT, t, i) for t in chat.NEXT[s]]
        if i < len(roles):
            for t in (1, 2, 3):
                extra = 0 if t == roles[i] else chat.RELABEL
                if t in chat.NEXT[s]:
                    moves.append((c + extra, t, i + 1))
                if t == s:
                    moves.append((c + extra + chat.MERGE, t, i + 1))
        for m in moves:
            if m[0] < best.get(m[1:], 1 << 60):
                best[m[1:]] = m[0]
                heapq.heappush(todo, m)


def test_chat(spark):
    rng = random.Random(11)
    names = ["system", "user", "assistant", "Assistant ", None, "bot"]
    rows = []
    for c in range(60):
        rows += [(c, t, rng.choice(names[:3] if c % 2 else names), rng.choice(["hi", "", None, "a\nb"]), "clash") for t in range(rng.randrange(1, 9))]
    rows += [(100, t, rng.choice(names), f"t{t}", "x") for t in range(3000)]
    rows += [(101, 1, "user", "same", "x")] * 3 + [(None, None, "user", "q", "x"), (None, 1, "assistant", "r", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, action string")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [r.asDict() for r in chat.repair(df).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(got) == len(rows)
    convs = collections.defaultdict(list)
    for r in got:
        convs[r["conv_id"]].append(r)
    for conv, rs in convs.items():
        rs = sorted(rs, key=lambda r: -1 if r["turn"] is None else r["turn"]) if conv != 101 else rs
        cost = sum(chat.RELABEL * ("relabel" in r["action"]) + chat.MERGE * ("merge" in r["action"])
                   + chat.INSERT * (len(r["inserted"]) + len(r["appended"])) for r in rs)
        assert cost == cheapest([chat.ROLES.get((r["role"] or "").strip().lower(), 0) for r in rs]), conv
        text = "".join(r["fragment"] for r in rs)
        turns = re.findall(r"<\|(system|user|assistant)\|>\n(.*?)<\|end\|>\n", text, re.S)
        assert "".join(f"<|{a}|>\n{b}<|end|>\n" for a, b in turns) == text
        order = [a for a, _ in turns]
        order = order[1:] if order[0] == "system" else order
        assert order == ["user", "assistant"] * (len(order) // 2) and order
        for r in rs:
            assert (r["text"] if "text" in r else "") is not None
    assert chat.repair(df.limit(0)).count() == 0


# pipeline and contract


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(12)
    vocabulary = words(rng, 400, "abcdefghijkl")

    def prose(n):
        return "\n".join(" ".join(rng.choice(vocabulary) for _ in range(min(30, n - i))) + "." for i in range(0, n, 30))

    texts = [(i, prose(rng.randrange(60, 400))) for i in range(60)]
    texts += [(100, texts[0][1]), (101, texts[1][1] + "\n" + prose(30)), (102, "short"), (103, None), (104, "spam " * 300), (105, "A | B | C " * 40)]
    docs_of(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, str(tmp_path))
        assert out.dtypes == docs.dtypes, name
        out = out.cache()
        ids = [r["doc_id"] for r in out.collect()]
        if name == "quality rules":
            assert set(range(60)) <= set(ids) and not {102, 103, 104, 105} & set(ids)
        if name == "line dedup":
            assert 100 not in ids and 101 in ids
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in rows} <= set(range(60)) | {101} and rows
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality rules" and len(corpus_pipeline.STAGES) == 5
    empty = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, str(tmp_path))
    assert empty.count() == 0


def test_contract():
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


def test_bitmaps_keep_similar_pairs(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9)))
    grams = lambda t: {t[i:i + 5] for i in range(len(t) - 4)} or {t}
    rows, want = [], set()
    for i in range(150):
        a = [word() for _ in range(rng.randint(12, 70))]
        b = list(a)
        for _ in range(rng.randint(0, max(1, len(a) // 12))):
            b[rng.randrange(len(b))] = word()
        x, y = " ".join(a), " ".join(b)
        rows += [(2 * i, x), (2 * i + 1, y)]
        if 100 * len(grams(x) & grams(y)) >= 75 * len(grams(x) | grams(y)):
            want.add((2 * i, 2 * i + 1))
    apart = {(4 * i, 4 * i + 2) for i in range(70)}
    rows += [(1000, "one two"), (1001, "one two!"), (1002, "long " * 5000), (1003, "long " * 4000)]
    df = spark.createDataFrame(rows, "node long, line string")
    bits = lines.bitmaps(df)
    pairs = spark.createDataFrame([*want, *apart, (0, 1000), (1000, 1001), (1002, 1003)], "hub long, node long")
    got = {tuple(r) for r in lines.plausible(pairs, bits).collect()}
    assert len(want) > 100 and want <= got  # no link is ruled out
    assert (1002, 1003) in got and (0, 1000) not in got
    assert len(apart & got) <= 2
    linked = {tuple(r) for r in lines.verify(pairs, df).collect()}
    text = dict(rows)
    assert linked == {(a, b) for a, b in want | apart | {(0, 1000), (1000, 1001), (1002, 1003)}
                      if 100 * len(grams(text[a]) & grams(text[b])) >= 75 * len(grams(text[a]) | grams(text[b]))}


def test_bitmaps_never_exceed_the_difference(spark):
    rng = random.Random(11)
    some = ["".join(rng.choice("abc é漢") for _ in range(rng.choice([1, 4, 5, 20, 300, 3000]))) for _ in range(80)]
    some += [x[: len(x) * 9 // 10] + "zz" for x in some]
    df = spark.createDataFrame(list(enumerate(some)), "node long, line string")
    rows = lines.bitmaps(df).collect()
    assert len(rows) == len(some)
    sets = {r["node"]: grams(some[r["node"]]) for r in rows}
    assert all(r["n"] >= len(sets[r["node"]]) for r in rows)
    for x, y in itertools.combinations(rows, 2):
        differ = sum(((x[f"b{i}"] ^ y[f"b{i}"]) & (2**64 - 1)).bit_count() for i in range(lines.BITMAP))
        assert differ <= len(sets[x["node"]] ^ sets[y["node"]])


def test_line_dedup_of_string_ids_and_clashing_columns(spark):
    rows = [("a", "one two three four five\nsecond line here", "x"), ("b", "one two three four five!", "y"), ("c", None, "z"), ("a2", "second line here\nown words of this", "w")]
    df = spark.createDataFrame(rows, "doc_id string, text string, _d string").withColumns({"kept": F.lit(1), "no": F.lit(2)})
    got = lines.dedup(df)
    drop = {r["doc_id"]: [(x["line_no"], x["keep_doc_id"], x["keep_line_no"]) for x in r["dropped"]] for r in got.collect()}
    assert drop == {"a": [], "b": [(0, "a", 0)], "c": [], "a2": [(0, "a", 1)]}
    out = {r["doc_id"]: r for r in lines.rewrite(df, got).collect()}
    assert set(out) == {"a", "c", "a2"} and out["a2"]["text"] == "own words of this" and out["a2"]["_d"] == "w"
    assert list(out["a"].asDict()) == df.columns


def test_checkpoint_puts_the_setting_back(spark):
    before = spark.conf.get(common.CLEANUP)
    d = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    c = common.checkpoint(d)
    assert c.count() == 7 and c.agg(F.sum("count")).first()[0] == 100 and d.count() == 7
    assert spark.conf.get(common.CLEANUP) == before
