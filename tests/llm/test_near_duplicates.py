"""SimHash and line deduplication against brute force over all pairs."""

import random
from collections import Counter
from math import ceil, floor, log2

from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

import corpus_pipeline
from larkspur.llm import linededup, simhash

WORDS = [f"w{i}x" for i in range(300)]


def texts(n, seed=1, length=60):
    """Texts with exact and near copies, in order."""
    rng, out = random.Random(seed), []
    for i in range(n):
        if out and rng.random() < 0.5:
            words = rng.choice(out).split(" ")
            for _ in range(rng.choice((0, 1, 1, 2))):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(WORDS)
            out.append(" ".join(words))
        else:
            out.append(" ".join(rng.choice(WORDS) for _ in range(rng.randint(0, length))))
    return out


def slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def groups(n, linked):
    at = list(range(n))
    for _ in range(n):
        before = at[:]
        for a, b in linked:
            at[a] = at[b] = min(at[a], at[b])
        if at == before:
            return at
    return at


def frame(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")


def test_fingerprint(monkeypatch):
    for t in [*texts(40), "", None, "One", "A b", " x y\x0bz", "É é Ü", "a " * 5000]:
        assert simhash.fingerprint(t) == slow_fingerprint(t)
    monkeypatch.setattr(simhash, "WORDS_AT_ONCE", 7)
    assert all(simhash.fingerprint(t) == slow_fingerprint(t) for t in texts(30, 4))


def test_masks_cover_all_pairs():
    masks = simhash.covering_masks(2)
    assert len(masks) == 7 and all(20 < bin(m & (1 << 64) - 1).count("1") < 45 for m in masks)
    assert all(any(not m & (1 << a | 1 << b) for m in masks) for a in range(64) for b in range(64))


def test_links_brute_force(spark):
    rng = random.Random(2)
    points = {rng.getrandbits(64) for _ in range(60)}
    for p in list(points)[:40]:
        for _ in range(3):
            points.add(p ^ 1 << rng.randrange(64) ^ (1 << rng.randrange(64) if rng.random() < 0.7 else 0))
    points = sorted(x - (1 << 64) if x >> 63 else x for x in points)
    near = [(i, j) for i in range(len(points)) for j in range(i) if bin((points[i] ^ points[j]) & (1 << 64) - 1).count("1") <= 2]
    for small in (24, 2):  # all by pairs, all by shared points
        found = simhash.links(spark.createDataFrame([(p,) for p in points], "fp long"), small=small).collect()
        at = {p: i for i, p in enumerate(points)}
        assert groups(len(points), [(at[r["u"]], at[r["v"]]) for r in found]) == groups(len(points), near)


def test_near_duplicates(spark):
    rows = [*texts(120, 3), "", None, "  ", "Solo"]
    prints = [slow_fingerprint(t) for t in rows]
    want = groups(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2])
    found = {r["doc_id"]: r for r in simhash.near_duplicates(frame(spark, rows).withColumn("fp", F.lit("x")).withColumn("u", F.lit(1))).collect()}
    assert [found[i]["component_id"] for i in range(len(rows))] == want
    assert [found[i]["fp"] & (1 << 64) - 1 for i in range(len(rows))] == prints
    assert sorted(r["doc_id"] for r in simhash.keep_first(frame(spark, rows)).collect()) == sorted(set(want))


def test_near_duplicates_edges(spark):
    rows = [(None, "a b c"), (4, "a b c"), (4, "a b c"), (7, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(str((r["doc_id"], r["component_id"])) for r in simhash.near_duplicates(df).collect()) == ["(4, 4)", "(4, 4)", "(7, 7)", "(None, 4)"]
    assert simhash.keep_first(df).count() == 4
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def slow_words(line):
    """The words of a line, normalised."""
    alnum = set("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
    out = []
    for w in line.split(" "):
        if len(w.encode()) > 1 or w in alnum:
            edge = (w[-1] < "0" or ":" <= w[-1] <= "@" or w[-1] == "]") or w[0] < "0"
            out.append((w.strip(linededup.PUNCTUATION) if edge else w).lower())
    return out


def word_hashes(spark, words):
    """XXH64 of normalised words as the operator takes them: 40 bits of it, and how many bits their letters are worth."""
    rows = spark.createDataFrame([(w,) for w in sorted(words)], "w string").select("w", F.xxhash64("w").alias("h")).collect()
    return {r["w"]: (r["h"] & (1 << 64) - 1) >> 12 & ~0xFFF | 2 * min(6, len(r["w"].encode())) for r in rows}


def slow_blocks(line, known, least=linededup.LEAST_BITS):
    """The blocks of a line, as tuples, without the library's columns."""
    x = [known[w] for w in slow_words(line)]
    n = len(x) if any(p in line for p in ("  ", " | ", " - ")) else len(line.split(" "))
    step = lambda n: 0 if n < 20 else 1 + int(log2(n / 20))
    out = set()
    for at in {step(n), step(ceil(n * 1.1))}:
        count = 4 if at == 0 else floor(5.6 * 2 ** (at - 1) + 0.5)
        sums = [0] * count
        for h in x:
            sums[(h >> 24) % count] += h
        if at == 0:
            out |= {(at, i, j, sums[i] + sums[j]) for i in range(4) for j in range(i) if (sums[i] + sums[j]) & 0xFFF >= least} | {(at, sum(sums))}
        else:
            out |= {(at, j, s) for j, s in enumerate(sums[:6]) if s & 0xFFF >= least}
    return out


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        now = [i + 1]
        for j, y in enumerate(b):
            now.append(min(row[j + 1] + 1, now[j] + 1, row[j] + (x != y)))
        row = now
    return row[-1]


def brute_lines(spark, rows, blocks=True):
    """The first line of each line's group, from all pairs; blocks: of those that meet in one, else by edit similarity alone."""
    lines = [(i, k, slow_words(line), line) for i, t in rows if t is not None for k, line in enumerate(t.split("\n"))]
    lines = [x for x in lines if len(x[2]) >= 5]
    known = word_hashes(spark, {w for x in lines for w in x[2]})
    met = [slow_blocks(x[3], known) if blocks else {0} for x in lines]
    similar = lambda a, b: 5 * distance(a, b) <= max(len(a), len(b))
    linked = [(a, b) for a in range(len(lines)) for b in range(a) if lines[a][3] == lines[b][3] or met[a] & met[b] and similar(lines[a][2], lines[b][2])]
    at = groups(len(lines), linked)
    return {(i, k): lines[at[n]][:2] for n, (i, k, _, _) in enumerate(lines)}


def first_lines(found):
    return {(r["doc_id"], r["line_no"]): (r["group_doc_id"], r["group_line_no"]) for r in found.collect()}


def test_blocks(spark):
    """Each line's blocks, over all steps of length, as they are by hand."""
    rng = random.Random(6)
    rows = [" ".join(rng.choice(WORDS) + rng.choice(("", ".", "!")) for _ in range(n)) for n in (5, 9, 15, 16, 19, 20, 31, 32, 39, 40, 63, 64, 100, 200, 900)] + ["one two three four. (FIVE) | six!! - x"]
    known = word_hashes(spark, {w for r in rows for w in slow_words(r)})
    found = linededup.blocked(linededup.hashed(frame(spark, rows))).groupBy("doc_id").agg(F.count_distinct("key").alias("blocks"))
    assert {r["doc_id"]: r["blocks"] for r in found.collect()} == {i: len(slow_blocks(r, known)) for i, r in enumerate(rows)}


def test_line_of_one_word(spark):
    """One word more often than a class can add up gives no block, and no failure; equal lines are copies in any case."""
    line = "zzzz " * 5000 + "(ZZZZ) zzzz. a b c d e f"
    found = first_lines(linededup.line_groups(frame(spark, [line, line, f"{line} g"])))
    assert len(found) == 3 and found[1, 0] == (0, 0)


def test_line_recall(spark):
    """Of the pairs of different lines with the edit similarity asked for, by all pairs of one corpus, those in one group."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lines = {" ".join(slow_words(line)): (r["doc_id"], k) for r in docs.collect() for k, line in enumerate((r["text"] or "").split("\n")) if len(slow_words(line)) >= 5}
    texts = [t.split(" ") for t in sorted(lines)]
    holds = {}
    for i, words in enumerate(texts):
        for w in set(words):
            holds.setdefault(w, []).append(i)
    near = set()
    for i, words in enumerate(texts):
        # of e edits at most, one of a line's e + 1 rarest different words stays
        rare = sorted(set(words), key=lambda w: len(holds[w]))[: len(words) // 4 + 2]
        for j in {j for w in rare for j in holds[w] if j < i and 4 * len(words) <= 5 * len(texts[j]) and 4 * len(texts[j]) <= 5 * len(words)}:
            longer = max(len(words), len(texts[j]))
            if 5 * (longer - sum((Counter(words) & Counter(texts[j])).values())) <= longer and 5 * distance(words, texts[j]) <= longer:
                near.add((i, j))
    group = first_lines(linededup.line_groups(docs))
    at = [group[lines[" ".join(t)]] for t in texts]
    found = sum(at[i] == at[j] for i, j in near)
    print(f"{found} of {len(near)}")
    assert len(near) > 100 and found >= 0.9 * len(near)


def test_line_groups(spark):
    pool = texts(36, 8, 25) + texts(12, 9, 120)
    rng = random.Random(9)
    rows = [(i, "\n".join(rng.choice(pool) + rng.choice(("", ".", " !")) for _ in range(4))) for i in range(14)] + [(20, None), (21, ""), (22, "a | b | c | d | e |"), (23, "x | y | z | v | w |")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_lines(spark, rows)
    assert first_lines(linededup.line_groups(df)) == want and len(set(want.values())) < len(want)
    kept = {r["doc_id"]: r for r in linededup.dedup_lines(df.withColumn("h", F.lit(1)).withColumn("a.b", F.lit(2)).withColumn("removed", F.lit("old"))).collect()}
    for i, t in rows:
        lines = t.split("\n") if t is not None else None
        gone = sorted(k for (j, k), g in want.items() if j == i and g != (j, k))
        assert kept[i]["removed"] == gone and kept[i]["n_lines"] == len(lines or ()) and kept[i]["h"] == 1 and kept[i]["a.b"] == 2
        assert kept[i]["text"] == (None if lines is None else "\n".join(x for k, x in enumerate(lines) if k not in gone))


def test_dense_cluster(spark):
    """Many different near copies of one line: all in one group, without all pairs."""
    base = [f"v{i}y" for i in range(60)]
    rows = [" ".join(base)] * 3 + [" ".join(w if k != i else "new" for k, w in enumerate(base)) for i in range(60)]
    want = brute_lines(spark, list(enumerate(rows)))
    assert first_lines(linededup.line_groups(frame(spark, rows))) == want and set(want.values()) == {(0, 0)}


def test_crowded_block(spark, monkeypatch):
    """A block of many lines that are not alike but for pairs of them: compared in parts, each pair found."""
    rng = random.Random(11)
    rows = []
    for i in range(40):
        line = ["shared", "phrase", "common", "everywhere"] + [f"own{i}w{k}" for k in range(8)]
        rows += [" ".join(line), " ".join([*line[:-1], f"other{i}"])]
    rng.shuffle(rows)
    want = brute_lines(spark, list(enumerate(rows)))
    monkeypatch.setattr(linededup, "CHUNK", 7)
    assert first_lines(linededup.line_groups(frame(spark, rows))) == want and len(set(want.values())) <= 45


def test_line_edges(spark):
    line = "one two three four five six"
    df = spark.createDataFrame([(None, line), (1, line), (1, line), (2, line + "\nx")], "doc_id long, text string")
    found = sorted(str((r["doc_id"], r["text"])) for r in linededup.dedup_lines(df).collect())
    assert found == sorted(map(str, [(None, line), (1, line), (1, line), (2, "x")]))
    assert linededup.dedup_lines(df.limit(0)).count() == 0


def test_op3_query(spark, tmp_path):
    """The query's columns by hand, with nulls and repeated rows, on a table with further columns."""
    rows = [*texts(40, 12), "", None, "same words here"]
    frame(spark, rows).union(frame(spark, rows).where("doc_id = 3")).withColumn("component_id", F.lit("x")).write.parquet(f"{tmp_path}/documents.parquet")
    prints = [slow_fingerprint(t) for t in rows]
    want = groups(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2])
    found = simhash.op3_simhash_near_dedup(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in found) == sorted([(i, f"{p:016x}", want[i]) for i, p in enumerate(prints)] + [(3, f"{prints[3]:016x}", want[3])])


def test_fingerprints_without_ids(spark):
    df = spark.createDataFrame([(None, "x y z"), (None, "x y z"), (5, "p q r s")], "doc_id long, text string")
    assert sorted(str((r["doc_id"], r["component_id"])) for r in simhash.near_duplicates(df).collect()) == ["(5, 5)", "(None, None)", "(None, None)"]


def short_pairs():
    """Lines of few words, by twos, and the numbers of those that are similar: with as many edits as are allowed and wherever they are."""
    rng, rows = random.Random(11), []
    for k in range(400):
        words = [f"k{k}n{i}" for i in range(rng.randint(5, 19))]
        other = words[:]
        for _ in range(len(words) // 5):
            at, kind = rng.randrange(len(other)), rng.choice("sid")
            other[at : at + 1] = {"s": [f"q{rng.random()}"], "i": [f"q{rng.random()}", other[at]], "d": []}[kind]
        rows += [" ".join(words), " ".join(other)]
    near = [k for k in range(0, len(rows), 2) if (n := max(len(a := rows[k].split(" ")), len(b := rows[k + 1].split(" ")))) < linededup.SHORT and min(len(a), len(b)) >= 5 and distance(a, b) <= n // 5]
    return rows, near


def test_short_lines_lose_no_pair(spark):
    """Pairs of lines of fewer than SHORT words are all linked."""
    rows, near = short_pairs()
    group = first_lines(linededup.line_groups(frame(spark, rows), whole=True))
    assert len(near) > 250 and not [rows[k : k + 2] for k in near if group[k, 0] != group[k + 1, 0]]


def test_pipeline_loses_no_short_pair(spark):
    """Of each such pair the pipeline keeps the first line only."""
    rows, near = short_pairs()
    kept = {r["doc_id"] for r in corpus_pipeline.lines_once(spark, frame(spark, rows), "").collect()}
    assert len(near) > 250 and not kept & {k + 1 for k in near} and {k for k in near} <= kept


def test_blocks_of_one_line_stay_out_of_the_join(spark, monkeypatch):
    """What is joined with a block's first line are the blocks of several lines, however few bits tell them; a full filter changes nothing else."""
    rng = random.Random(12)
    rows = [" ".join(f"r{i}w{k}" for k in range(rng.randint(5, 40))) for i in range(150)]
    rows += [f"{x} more" for x in rows[:10]]
    seen, join = [], linededup.join_counted
    monkeypatch.setattr(linededup, "join_counted", lambda left, right, key, *a: (key == "key" and seen.append(left.count()), join(left, right, key, *a))[1])
    want = brute_lines(spark, list(enumerate(rows)), blocks=False)
    assert first_lines(linededup.line_groups(frame(spark, rows), whole=True)) == want and len(set(want.values())) == 150
    monkeypatch.setattr(linededup, "FILTER_WORDS", 1)
    assert first_lines(linededup.line_groups(frame(spark, rows), whole=True)) == want
    assert seen[0] < 0.3 * seen[1]
