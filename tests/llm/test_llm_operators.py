"""Each operator against a brute-force version or an exact round trip, with the
cases its docstring defines: NULLs, empty and long texts, ties, repeated rows,
empty tables, extra columns."""

import hashlib
import random
import re
import struct
import zlib
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from txrisk.llm import (
    html_text,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    vector_search,
    warc,
)
from txrisk.llm.components import connected
from txrisk.session import scratch_dir

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
ODD = [(None, "no id here at all, five words"), (1, None), (2, ""), (3, " \n\t"), (3, " \n\t")]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def text_of(seed, n, vocabulary=5000):
    draw = random.Random(seed)
    letters = str.maketrans("0123456789", "abcdefghij")
    return " ".join(f"w{draw.randrange(vocabulary)}".translate(letters) for _ in range(n))


def edited(text, *places):
    parts = text.split(" ")
    for place in places:
        parts[place] = f"e{place}"
    return " ".join(parts)


# n-gram join


def brute_components(rows):
    sets = []
    for _, text in rows:
        w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * len(sets[i] | sets[j]):
            old, new = label[i], label[j]
            label = [new if x == old else x for x in label]
    least = {}
    for k, (doc_id, _) in zip(label, rows):
        if doc_id is not None:
            least[k] = min(doc_id, least.get(k, doc_id))
    return sorted(
        ((d, len(s), least.get(k)) for (d, _), s, k in zip(rows, sets, label)), key=str
    )


def test_ngram_join_is_brute_force(documents):
    rows = list(ODD) + [(4, "Short text"), (5, "short TEXT")]
    for group in range(6):
        base = text_of(group, 60 + 40 * group)
        for copy in range(7):
            places = random.Random(copy).sample(range(60), copy % 4)
            rows.append((100 + 10 * group + copy, edited(base, *places)))
    rows += [(400 + i, text_of(99, 40) + " " + text_of(1000 + i, 30)) for i in range(12)]
    df = documents(rows, extra="component")
    for join in (ngram_join.Join(), ngram_join.Join(block=3, first=1, few=0, groups=8)):
        found = ngram_join.ngram_join(df, join).drop("text_id")
        assert sorted(map(tuple, found.collect()), key=str) == brute_components(rows)


def test_representatives_keep_one_of_each(documents):
    base = text_of(5, 80)
    rows = [*ODD, (10, base), (11, edited(base, 3)), (11, base), (20, text_of(6, 80))]
    kept = ngram_join.representatives(documents(rows))
    assert kept.columns == documents(rows).columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted([None, 1, 2, 3, 3, 10, 20], key=str)
    assert ngram_join.representatives(documents(rows).limit(0)).count() == 0


def test_tree_bound_loses_no_pair():
    draw = np.random.default_rng(1)
    points = draw.integers(0, 5, (300, 16)).astype("<u4")
    sizes = points.sum(axis=1).astype(np.int64)
    order = np.argsort(sizes, kind="stable")
    points, sizes = points[order], sizes[order]
    tree = ngram_join.RTree(points, sizes, 80, page=4)
    for i in range(300):
        bound = np.minimum(points[:i], points[i]).sum(axis=1)
        want = np.flatnonzero(180 * bound >= 80 * (sizes[:i] + sizes[i]))
        assert sorted(tree.survivors(points[i], sizes[i], i)) == want.tolist()


@pytest.mark.parametrize("groups", [1, 2, 8, 64])
def test_bounds_by_groups_hold_above_a_byte(groups):
    draw = np.random.default_rng(groups)
    whole = draw.integers(0, 1 << 63, 6000).astype(np.uint64)
    sets = [np.unique(draw.choice(whole, n)) for n in (5, 300, 2000, 4000, 9000, 9000)]
    sizes = np.array([len(s) for s in sets])
    points = ngram_join.Points.of(np.stack([ngram_join.counts(s, groups) for s in sets]), sizes)
    folded = points.coordinates(4)
    assert (folded.sum(axis=1) == sizes).all()
    for i, j in combinations(range(len(sets)), 2):
        bound = points.bound(i, j)
        tree_bound = np.minimum(folded[i], folded[j]).sum()
        assert len(np.intersect1d(sets[i], sets[j])) <= bound <= tree_bound <= min(sizes[i], sizes[j])


def test_long_texts_above_a_byte_are_brute_force(documents):
    base = text_of(7, 1200)
    rows = [(k, edited(base, *range(0, 1200, 1200 // (8 * k + 1)))) for k in range(9)]
    found = ngram_join.ngram_join(documents(rows), ngram_join.Join(groups=2)).drop("text_id")
    assert sorted(map(tuple, found.collect()), key=str) == brute_components(rows)


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(50, 51), (60, 60)]
    found = connected(spark.createDataFrame(chain, "u BIGINT, v BIGINT"))
    assert dict(found.collect()) == {**{i: 1 for i in range(2, 41)}, 51: 50}
    assert connected(spark.createDataFrame([], "u BIGINT, v BIGINT")).count() == 0


# quality


def test_classifier_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = quality_classifier.classify(docs, labels)
    rows = found.filter("held_out").join(labels, "doc_id").toPandas()
    assert ((rows.score >= 0.3) == (rows.predicted == 1)).all()
    assert (rows.predicted == rows.quality).mean() >= 0.9
    for row in found.limit(50).collect():
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)


def test_classifier_edge_rows(documents, spark):
    labels = spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT")
    found = quality_classifier.classify(documents(ODD), labels).collect()
    assert len(found) == len(ODD) and all(r.score == 0.5 for r in found)


def brute_rules(text):
    w = words(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (
        len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(covered),
        len(w) < 50 or 100 * len(covered) > 50 * len(w),
    )


def test_quality_rules_are_brute_force(documents):
    texts = ["a b c a b c a b", "x " * 70, text_of(1, 90, 4), text_of(2, 300, 30), "# a*b <c>\né\né"]
    texts += [text_of(3, 60) + "\n" + text_of(3, 60) + "\n\n \n", "a b c d a b"]
    rows = list(ODD) + [(10 + i, t) for i, t in enumerate(texts)]
    found = quality_rules.quality_rules(documents(rows, extra="words"))
    got = sorted(
        ((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
          r.base_failed) for r in found.collect()), key=str
    )
    assert got == sorted(((d, *brute_rules(t)) for d, t in rows), key=str)


def test_frequent_lines_go_and_depleted_documents_too(documents):
    limits = quality_rules.Limits(host_share=0.1, least=3, kept_share=0.5)
    common = " ".join("c" * (k % 5 + 1) + "d" * (k // 5) for k in range(80))
    rows = [(i, f"{common}\n{text_of(i, 55)}", "h") for i in range(8)]
    rows += [(20 + i, f"{common}\n{text_of(50 + i, 200)}", "h") for i in range(4)]
    rows += [(40 + i, f"{text_of(777, 60)}\n{text_of(778, 60)}", "h") for i in range(9)]
    rows += [(60, f"{common}\n{text_of(900, 90)}", "other"), (61, None, None)]
    found = {r.doc_id: r for r in quality_rules.quality_rules(documents(rows), limits).collect()}
    assert not any(found[i].kept for i in range(8))
    assert all(found[20 + i].kept and found[20 + i].removed_words == 80 for i in range(4))
    assert all(found[40 + i].kept and found[40 + i].removed_words == 0 for i in range(9))
    assert found[60].removed_words == 0 and not found[61].kept
    kept = {r.doc_id: r for r in quality_rules.kept_documents(documents(rows), limits).collect()}
    assert kept[20].text == text_of(50, 200) and kept[20].n_chars == len(kept[20].text)


# search


def test_search_is_brute_force(spark):
    draw = np.random.default_rng(3)
    vectors = [v.tolist() for v in draw.normal(size=(400, 8))] + [[0.5] * 8] * 30
    rows = [(i, v, 1) for i, v in enumerate(vectors)]
    rows += [(900, None, 1), (800, [None] * 8, 1), (700, [float("nan")] * 8, 1), (600, [1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>, rank INT")
    ints = {
        i: np.floor(1024 * np.array(v, dtype=np.float32).astype(float)).astype(int)
        for i, v, _ in rows[: len(vectors)]
    }
    found = vector_search.search(df, F.col("vec_id") % 100 == 0, tree_rows=100, block=3)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for q in (0, 100, 200, 300, 400):
        scores = sorted((-int(ints[q] @ v), i) for i, v in ints.items() if i != q)[:10]
        assert got[q] == [(i, -s) for s, i in scores]
    assert set(got) == {0, 100, 200, 300, 400}
    assert vector_search.search(df.limit(0), F.lit(True)).count() == 0


# personal data


def test_base_spans_as_the_patterns_say():
    pattern = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    draw = random.Random(4)
    for _ in range(3000):
        text = "".join(draw.choice("ab.@-_ é1") for _ in range(draw.randrange(30)))
        assert list(pii.email_spans(text)) == [m.span() for m in pattern.finditer(text)]
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for _ in range(3000):
        text = "".join(draw.choice("12.. a") for _ in range(draw.randrange(40)))
        assert [m.span() for m in pii.IP.finditer(text)] == [m.span() for m in ip.finditer(text)]


def test_personal_data(documents):
    text = "é mail a.b@c.de, 256.1.1.1 10.0.0.1 card 4111 1111 1111 1111 or 4111111111111112 +49 (0)30-1234567"
    rows = [(7, text), (8, "IBAN DE89370400440532013000, DE88370400440532013000"), *ODD]
    found = {r.doc_id: r for r in pii.personal_data(documents(rows)).collect()}
    row = found[7]
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 1, 1, 1)
    shown = [(k, text[int(a) : int(b)]) for k, a, b in (s.split(":") for s in row.spans.split(","))]
    assert shown == [
        ("email", "a.b@c.de"), ("ip", "10.0.0.1"), ("card", "4111 1111 1111 1111"),
        ("phone", "+49 (0)30-1234567"),
    ]
    assert row.base_sha256 == hashlib.sha256(row.spans.encode()).hexdigest()
    assert found[8].spans == "iban:5:27"
    assert found[1].spans == "" and found[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.find_spans("1" * 200_000 + " a" * 10 + "@" * 50_000) == []


# html


def page(body):
    return f"<!DOCTYPE html><html><head><title>t</title></head><body>{body}</body></html>"


def test_neighbours_tell_the_template(spark):
    frame = "<div>Welcome to us</div><div>{}</div><p>{}</p><div>Contact | Imprint</div>"
    rows = [(i, f"http://h.org/a/{i:03}", page(frame.format(f"Story {i}", f"Body &amp; {i}"))) for i in range(9)]
    rows += [(20, None, None), (21, "x", ""), (0, rows[0][1], rows[0][2])]
    df = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING")
    found = sorted((r.page_id, r.text, r.n_chars) for r in html_text.extract(df).collect())
    want = [(i, f"Story {i} Body & {i}", len(f"Story {i} Body & {i}")) for i in [0, 0, *range(1, 9)]]
    assert found == want + [(20, "", 0), (21, "", 0)]


def test_landmarks_and_broken_markup():
    source = page(
        "<nav><li>Menu</nav><div class='ad box'>Buy</div><article><h1>A  &lt;b&gt;</h1><p><b>One<br>two"
        "<p>th<i>r</i>ee<script>var x='</p>'</script><form>Mail</form><div class=comments>Me!</div>"
        "<p title='a>b'>four 1 < 2</article><footer>End"
    )
    assert html_text.main_text(html_text.parse(source), [], 0.8) == "A <b> One two three four 1 < 2"


def test_alignment_is_a_longest_common_subsequence():
    draw = random.Random(5)
    for _ in range(500):
        a, b = ([draw.choice("abcd") for _ in range(draw.randrange(14))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = max(table[i][j + 1], table[i + 1][j], table[i][j] + (x == y))
        assert len(html_text.shared_lines(a, b)) == table[-1][-1]


# mixing


def brute_targets(sizes, weights=(5, 2, 1)):
    total, free = 1.5 * sum(sizes), dict(enumerate(sizes))
    weight = {i: weights[i % 3] for i in free}
    target = {}
    while free:
        level = (total - sum(target.values())) / sum(weight[i] for i in free)
        over = [i for i in free if weight[i] * level > 2 * sizes[i]]
        if not over:
            return [target.get(i, weight[i] * level) for i in range(len(sizes))]
        for i in over:
            target[i] = 2.0 * sizes[i]
            del free[i]
    return [target[i] for i in range(len(sizes))]


def test_targets_and_uses(documents):
    rows, names = [], ["B", "a", "c", "é", None]
    for k, n in enumerate((5, 400, 30, 200, 3)):
        rows += [(1000 * k + i, text_of(i, 20 + i % 7), names[k]) for i in range(n)]
    rows += [(5000, None, "a"), (5000, None, "a"), (None, "one two", "a")]
    df = documents(rows, extra="target2")
    found = mixing.plan_mix(df)
    assert found.count() == len(rows)
    sizes = [sum(len(words(r[1])) for r in rows if r[2] == n) for n in names]
    targets = brute_targets(sizes)
    per = {
        r.source: r
        for r in found.groupBy("source")
        .agg(F.first("source_size").alias("size"), F.first("target").alias("target"),
             F.sum(F.col("size") * F.col("uses")).alias("taken"), F.max("uses").alias("uses"))
        .collect()
    }
    for name, size, target in zip(names, sizes, targets):
        row = per[name]
        assert row.size == size and row.target == pytest.approx(target)
        assert abs(row.taken - target) <= 30 and row.uses <= 2
    again = {r.doc_id: r.uses for r in mixing.plan_mix(df.repartition(7)).collect()}
    assert again == {r.doc_id: r.uses for r in found.collect()}
    mixed = mixing.mix(df)
    assert mixed.count() == found.agg(F.sum("uses")).first()[0]
    assert mixing.mix(df.limit(0)).count() == 0


# packing


def test_first_fit_decreasing():
    draw = random.Random(6)
    sizes = sorted((draw.randrange(1, 100) for _ in range(300)), reverse=True)
    free, want = [], []
    for size in sizes:
        for k, left in enumerate(free):
            if left >= size:
                break
        else:
            k, left = len(free), 100
            free.append(100)
        want.append((k, 100 - left))
        free[k] -= size
    assert packing.first_fit_decreasing(sizes, 100) == want


def test_packing_keeps_every_token(documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    texts = [text_of(i, n) for i, n in enumerate((3, 900, 5000, 40))]
    texts += ["Don't x's. É é ́x <|endoftext|> İ ﬁ 12a34 ...!! ,a, \x1c \x85 日本 ΑΣ. a\x00b"]
    rows = [*ODD, *((10 + i, t) for i, t in enumerate(texts))]
    found = packing.pack(documents(rows), TOKENIZER, with_ids=True).collect()
    for doc_id, text in rows[len(ODD) :]:
        mine = sorted((r for r in found if r.doc_id == doc_id), key=lambda r: r.start)
        ids = [i for r in mine for i in struct.unpack(f"<{r.length}I", r.ids)]
        assert ids == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        assert all(r.ids_crc32 == zlib.crc32(r.ids) and r.doc_tokens == len(ids) for r in mine)
    assert sum(r.doc_tokens == 1 for r in found) == 4
    sequences = {}
    for r in sorted(found, key=lambda r: r.offset):
        assert r.offset == sequences.get(r.sequence_id, 0)
        sequences[r.sequence_id] = r.offset + r.length
    assert max(sequences.values()) <= 2048
    assert packing.pack(documents(rows).limit(0), TOKENIZER).count() == 0


# archives


def test_archive_round_trip(spark):
    inner = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:9:z>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(1, "u", "<p>"), (5, "ü\r\n", "<p>"), (2, "u", f"a {inner} WARC/1.1\r\n"), (3, None, None)]
    rows += [(4, "u", ""), (7, "u", inner), (5, "u", "<p>"), (None, "u", "<p>"), (8, "u", "é" * 5000)]
    df = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING")
    path = scratch_dir(spark, "archive")
    warc.write_archive(df.repartition(2), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        got = sorted(map(tuple, warc.read_archive(spark, path).collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    best = {}
    for page_id, _, text in rows:
        best[text or ""] = max(best.get(text or "", -1), -1 if page_id is None else page_id)
    want = []
    for page_id, _, text in rows:
        raw, first = (text or "").encode(), page_id == best[text or ""]
        kind = ("response", None) if first else ("revisit", best[text or ""])
        want.append((page_id, len(raw), warc.payload_digest(raw), *kind))
    assert got == sorted(want, key=str)


# line dedup


def brute_deleted(rows, least):
    """Lines in some run of at least ``least`` words with an earlier copy."""
    seqs = [[x for x in (t or "").split("\n") if words(x)] for _, t in rows]
    seen, gone = set(), [set() for _ in rows]
    for d, lines in enumerate(seqs):
        for i in range(len(lines)):
            for j in range(i + 1, len(lines) + 1):
                if sum(len(words(x)) for x in lines[i:j]) >= least:
                    if tuple(lines[i:j]) in seen:
                        gone[d].update(range(i, j))
                    seen.add(tuple(lines[i:j]))
    return [(d, len(s), len(g)) for (d, _), s, g in zip(rows, seqs, gone)]


def test_line_dedup_is_brute_force(documents):
    draw = random.Random(8)
    pool = [" ".join(f"p{k}w{i}" for i in range(1 + k % 7)) for k in range(6)]
    rows = []
    for doc_id in range(60):
        lines = [draw.choice([*pool, "", " "]) for _ in range(draw.randrange(14))]
        rows.append((doc_id, "\n".join(lines)))
    rows += [(100, pool[0] * 3), (101, None), (102, rows[3][1]), (103, rows[3][1])]
    found = line_dedup.line_dedup(documents(rows, extra="rank"), min_words=9)
    got = sorted((r.doc_id, r.n_lines, r.n_deleted) for r in found.collect())
    # places are compared in order, so copies inside one text count as well
    assert got == brute_deleted(rows, 9)


def test_long_runs_and_whole_copies(documents, numbered_lines):
    whole = numbered_lines(*range(70))
    rows = [(1, whole), (2, whole), (3, numbered_lines(900) + "\n" + numbered_lines(*range(10, 60)))]
    rows += [(4, numbered_lines(5)), (5, numbered_lines(5) + "\n" + numbered_lines(77))]
    kept = {r.doc_id: r.text for r in line_dedup.kept_documents(documents(rows)).collect()}
    assert kept == {1: whole, 3: numbered_lines(900), 4: rows[3][1], 5: rows[4][1]}
    assert line_dedup.line_dedup(documents(rows).limit(0)).count() == 0


def test_pipeline_over_the_smallest_tables(spark):
    import corpus_pipeline

    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    lengths = found.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0]
    assert found.count() > 0 and lengths <= 2048
