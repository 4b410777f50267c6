"""Each stage of the pipeline's run against brute force."""

import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import pytest
from test_llm_operators import brute_components, brute_rules, brute_targets, words
from tokenizers import Tokenizer

import corpus_pipeline
from txrisk.llm.queries import TOKENIZER


def prose(seed, n=70):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(4)) for _ in range(n))


def source_rows():
    footer = "read more of this\nin our other parts"
    rows = [(i, f"{prose(i)}\n{footer}" if i % 2 else prose(i), "a") for i in range(40)]
    rows += [(100 + i, f"{prose(100 + i)}\n{prose(500 + i, 30)}", "b") for i in range(20)]
    rows += [(200 + i, prose(100 + i) + "\n" + prose(600 + i), "b") for i in range(4)]
    rows += [(300 + i, prose(10 + 2 * i), "c") for i in range(4)]  # exact copies
    rows += [(310 + i, prose(20 + 2 * i) + " end", "c") for i in range(4)]  # near copies
    rows += [(400, "too short", "a"), (401, "x y z " * 40, "b"), (402, None, "a"), (403, "", None)]
    rows += [(410 + i, "\n".join([prose(700 + i, 5), prose(800)]), "d") for i in range(5)]  # depleted
    return rows


def brute_quality(rows):
    hosts, holders, texts = Counter(r[2] or "" for r in rows), defaultdict(set), {}

    def normal(line):
        return re.sub("[0-9]+", "0", " ".join(words(line.lower())))

    for doc_id, text, source in rows:
        texts[doc_id] = [x for x in (text or "").split("\n") if words(x)]
        for line in texts[doc_id]:
            holders[source or "", normal(line)].add(text)
    kept = []
    for doc_id, text, source in rows:
        n, *_, failed = brute_rules(text)
        rest = [
            x for x in texts[doc_id]
            if len(holders[source or "", normal(x)]) <= max(2, 0.02 * hosts[source or ""])
        ]
        if not failed and sum(len(words(x)) for x in rest) >= 0.2 * n:
            kept.append((doc_id, "\n".join(rest), source))
    return kept


def brute_lines(rows, least=50):
    seen, kept = set(), []
    for doc_id, text, source in sorted(rows):
        lines, gone = text.split("\n"), set()
        for i in range(len(lines)):
            for j in range(i + 1, len(lines) + 1):
                if sum(len(words(x)) for x in lines[i:j]) >= least:
                    if tuple(lines[i:j]) in seen:
                        gone.update(range(i, j))
                    seen.add(tuple(lines[i:j]))
        if rest := [x for k, x in enumerate(lines) if k not in gone]:
            kept.append((doc_id, "\n".join(rest), source))
    return kept


@pytest.fixture
def stages(spark, documents, tmp_path, monkeypatch):
    """Rows of every stage as run() stores them."""
    documents(source_rows()).write.parquet(str(tmp_path / "documents.parquet"))
    found, store = {}, corpus_pipeline.stored

    def stored(df, label):
        rows = store(df, label)
        found[label.removeprefix("stage-")] = rows.collect()
        return rows

    monkeypatch.setattr(corpus_pipeline, "stored", stored)
    corpus_pipeline.run(spark, str(tmp_path))
    return found


def test_stages_are_brute_force(stages):
    assert list(stages) == [name for name, _ in corpus_pipeline.STAGES]
    got = {k: sorted((r.doc_id, r.text, r.source) for r in rows)
           for k, rows in stages.items() if k != "packing"}
    want = sorted(brute_quality(source_rows()))
    assert got["quality_rules"] == want
    assert {r[0] for r in source_rows()} - {r[0] for r in want} == {*range(400, 404), *range(410, 415)}
    assert not any("read more" in r[1] for r in want)
    want = brute_lines(want)
    assert got["line_dedup"] == want
    assert {300, 301, 302, 303}.isdisjoint(r[0] for r in want)
    first = {d for d, _, component in brute_components([r[:2] for r in want]) if d == component}
    want = [r for r in want if r[0] in first]
    assert got["ngram_join"] == want and not first & {310, 311, 312, 313}

    sizes, taken, longest = Counter(), Counter(), max(len(words(r[1])) for r in want)
    for _, text, source in want:
        sizes[source] += len(words(text))
    for _, text, source in got["mixing"]:
        taken[source] += len(words(text))
    names = sorted(sizes)
    for name, target in zip(names, brute_targets([sizes[x] for x in names])):
        assert abs(taken[name] - target) <= longest
    uses = Counter(got["mixing"])
    assert set(uses) <= set(want) and max(uses.values()) <= 2

    tokenizer, pieces = Tokenizer.from_file(TOKENIZER), Counter()
    for (doc_id, text, _), n in uses.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        for start in range(0, len(ids), 2048):
            part = ids[start : start + 2048]
            crc = zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            pieces[doc_id, start, len(part), crc, len(ids)] += n
    packed = stages["packing"]
    assert pieces == Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in packed)
    ends = Counter()
    for r in sorted(packed, key=lambda r: r.offset):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= 2048
