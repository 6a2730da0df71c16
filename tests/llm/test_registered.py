"""The registered queries without SQL, and the pipeline stage by stage, against plain versions on a small planted corpus."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from geoloom.llm.queries import QUERIES, tokenizer_path
from geoloom.llm.toxicity import MOST_COUNTED, REJECT, features, fit_toxicity

RNG = random.Random(17)
VOCABULARY = ["".join(RNG.choices("abcdefghijklmnop", k=RNG.randint(3, 8))) for _ in range(600)]
SLURS = ["vexgrub", "snarlok", "drabfip"]


def prose(n: int) -> list[str]:
    return [RNG.choice(VOCABULARY) for _ in range(n)]


ITEMS = {1: prose(20), 2: prose(45), 3: prose(5), 4: prose(30)}


def corpus() -> tuple[dict[int, str | None], dict[int, int]]:
    """Texts by id and toxic labels of some."""
    texts: dict[int, str | None] = {i: " ".join(prose(RNG.randint(40, 120))) for i in range(1, 71)}
    labels = dict.fromkeys(range(1, 61), 0)
    for i in range(100, 140):
        words = prose(40)
        for at in range(0, 40, 6):
            words[at] = RNG.choice(SLURS)
        texts[i] = " ".join(words)
        if i < 130:
            labels[i] = 1
    for copy, original in ((200, 5), (201, 5), (202, 9)):
        words = texts[original].split()
        if copy != 200:
            words[len(words) // 2] = "changed"
        texts[copy] = " ".join(words)
    for i, item, edits in ((210, 1, 0), (211, 2, 4), (212, 3, 0), (213, 4, 6), (214, 4, 12)):
        words = list(ITEMS[item])
        for at in sorted(RNG.sample(range(len(words)), edits), reverse=True):
            words[at] = "edited"
        texts[i] = " ".join([*prose(15), *words, *prose(15)])
    for i in (220, 221):
        texts[i] = " ".join([*prose(20), f"write to ann{i}@mail.example.org or +49 30 12345{i % 10},", "host 10.2.3.4", "card 4111 1111 1111 1111", *prose(20)])
    texts |= {230: None, 231: "", 232: " \n\t ", 233: "One Word", 234: "é漢 naïve" + " x" * 5000}
    return texts, labels


TEXTS, LABELS = corpus()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(sorted(TEXTS.items()), "doc_id long, text string").selectExpr("*", "'en' AS lang", "'s' AS source", "cast(length(text) AS long) AS n_chars") \
        .repartition(3, "doc_id").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(sorted(LABELS.items()), "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(i, " ".join(w)) for i, w in ITEMS.items()], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def rows(spark, folder, name):
    return QUERIES[name](spark, folder).toPandas()


def plain_scores(model, text: str | None) -> list[float]:
    """P(grade >= k) for each threshold, from the weights."""
    score = sum(w * min(features(text).get(f, 0), MOST_COUNTED) for f, w in model.weights.items())
    return [1 / (1 + math.exp(t - score)) for t in model.thresholds]


def test_toxicity(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = fit_toxicity(docs, labels)
    assert {w for w in model.weights if model.weights[w] > 0} >= set(SLURS) and list(model.thresholds) == sorted(model.thresholds)
    got = rows(spark, folder, "op1_toxicity").set_index("doc_id")
    assert len(got) == len(TEXTS)
    for i, text in TEXTS.items():
        above = plain_scores(model, text)
        grades = [a - b for a, b in zip([1.0, *above], [*above, 0.0])]
        assert abs(got.p_toxic[i] - above[0]) < 1e-9 and abs(got.expected_severity[i] - sum(above)) < 1e-9 and got.grade[i] == int(np.argmax(grades))
        assert got.rejected[i] == (above[0] >= REJECT) == (100 <= i < 140)


def distance_to_run(item: list[str], words: list[str]) -> int:
    row = [0] * (len(words) + 1)
    for i, a in enumerate(item, 1):
        last, row = row, [i]
        for j, b in enumerate(words, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (a != b)))
    return min(row)


def contaminated(text: str | None) -> dict[int, int]:
    """Items that a text holds, with their distance."""
    words = re.findall(r"[^\s!-/:-@\[-`{-~]+", (text or "").lower())
    found = {i: distance_to_run(item, words) for i, item in ITEMS.items() if words}
    return {i: d for i, d in found.items() if d <= (len(ITEMS[i]) // 5 if len(ITEMS[i]) >= 8 else 0)}


def test_decontamination(spark, folder):
    got = rows(spark, folder, "op4_decontamination")
    want = sorted((i, item, d) for i, t in TEXTS.items() for item, d in contaminated(t).items())
    assert sorted(zip(got.doc_id, got.item_id, got.distance, strict=True)) == want and {w[0] for w in want} == {210, 211, 212, 213}
    for r in got.itertuples():
        run = TEXTS[r.doc_id].lower().split()[r.start_word:r.end_word]
        full = [list(range(len(run) + 1))]
        for i, a in enumerate(ITEMS[r.item_id], 1):
            full.append([i])
            for j, b in enumerate(run, 1):
                full[-1].append(min(full[-2][j] + 1, full[-1][-1] + 1, full[-2][j - 1] + (a != b)))
        assert full[-1][-1] == r.distance


def luhn(digits: str) -> bool:
    doubled = [int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([ -]?[0-9])+", lambda m: 12 <= len(re.sub("[ -]", "", m)) <= 19 and luhn(re.sub("[ -]", "", m))),
    ("phone", r"\+[0-9][ ().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
]


def base_spans(text: str | None) -> list[tuple[int, int, str, int]]:
    return sorted((m.start(), k, kind, m.end()) for k, (kind, pattern, right) in enumerate(PATTERNS) for m in re.finditer(pattern, text or "") if right(m[0]))


def test_personal_data(spark, folder):
    got = rows(spark, folder, "op5_personal_data").set_index("doc_id")
    assert len(got) == len(TEXTS)
    for i, text in TEXTS.items():
        spans = base_spans(text)
        listed = [f"{kind}:{a}:{b}" for a, _, kind, b in spans]
        assert got.base_sha256[i] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [int(got[f"n_{kind}"][i]) for kind, *_ in PATTERNS] == [sum(s[2] == kind for s in spans) for kind, *_ in PATTERNS]
        assert set(listed) <= set(got.spans[i].split(","))
    assert got.n_email[220] == got.n_phone[220] == got.n_ip[220] == got.n_card[220] == 1


def packed_as(pieces, texts: dict[int, str | None], size: int):
    """The pieces give back each document's ids and fill their sequences without a gap."""
    tokenizer = Tokenizer.from_file(tokenizer_path())
    by_doc = dict(list(pieces.groupby("doc_id")))
    assert set(by_doc) == set(texts)
    for i, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in by_doc[i].sort_values("start").itertuples():
            assert r.start == at and r.doc_tokens == len(ids) and r.crc == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    ordered = pieces.sort_values(["sequence_id", "offset"])
    assert (ordered.offset == ordered.groupby("sequence_id").length.cumsum() - ordered.length).all()
    totals = pieces.groupby("sequence_id").length.sum()
    assert all(n == size or n < size and n & (n - 1) == 0 for n in totals)


def test_packing(spark, folder):
    packed_as(rows(spark, folder, "op6_packing").rename(columns={"ids_crc32": "crc"}), TEXTS, 4096)


def test_sharding(spark, folder):
    got = rows(spark, folder, "op9_sharding").set_index("doc_id").sort_index()
    assert list(got.index) == sorted(TEXTS) and set(got.law) == {"bytes"} and got.grown_shard.isna().all() and got["shard"].between(0, 23).all()
    for i, text in TEXTS.items():
        raw = (text or "").encode()
        assert got["size"][i] == len(raw) + 8 and got.text_crc32[i] == zlib.crc32(raw)
    assert got["shard"].is_monotonic_increasing
    for _, shard in got.groupby("shard"):
        assert list(shard.slot) == list(range(len(shard)))
    # Each border lies within half a document of its share.
    total, ends = got["size"].sum(), got.groupby("shard")["size"].sum().reindex(range(24), fill_value=0).cumsum()
    assert all(abs(ends[k] - total * (k + 1) / 24) <= got["size"].max() / 2 + total / 24_000 for k in range(23))


def near_groups(texts: dict[int, str | None]) -> dict[int, int]:
    """Smallest id that each id reaches."""
    sets = {}
    for i, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    least = {i: i for i in texts}
    changed = True
    while changed:
        changed = False
        for i in texts:
            for j in texts:
                if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) and least[j] < least[i]:
                    least[i], changed = least[j], True
    return least


def test_pipeline_stage_by_stage(spark, folder):
    docs, model = spark.read.parquet(f"{folder}/documents.parquet"), fit_toxicity(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    expected = {i: t for i, t in TEXTS.items() if plain_scores(model, t)[0] < REJECT}
    steps = [expected]
    least = near_groups(expected)
    steps.append(expected := {i: t for i, t in expected.items() if least[i] == i})
    steps.append(expected := {i: t for i, t in expected.items() if not contaminated(t)})

    def masked(text: str | None) -> str | None:
        for start, _, kind, end in reversed(base_spans(text)):
            text = text[:start] + f"[{kind.upper()}]" + text[end:]
        return text

    steps.append(expected := {i: masked(t) for i, t in expected.items()})
    assert {5, 9, 214, 220, 230, 231} <= set(expected) and not {100, 139, 200, 201, 202, 210, 211, 212, 213} & set(expected) and "[EMAIL]" in expected[220]
    kept = docs
    for (name, stage), want in zip(corpus_pipeline.STAGES[:-1], steps, strict=True):
        out = stage(spark, kept, folder)
        assert sorted(out.columns) == sorted(docs.columns), name
        kept = spark.createDataFrame(out.select(*docs.columns).toArrow())
        assert {r.doc_id: r.text for r in kept.collect()} == want, name
    from pyspark.sql import functions as F

    packed_as(corpus_pipeline.run(spark, folder).withColumn("crc", F.crc32("ids")).toPandas(), steps[-1], 4096)
