"""The methods against brute force on small inputs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from geoloom.llm import decontaminate, near_dedup, substring, topk
from geoloom.llm.components import components
from geoloom.llm.packing import Tokens
from geoloom.llm.pii import KINDS, Finder
from geoloom.llm.queries import QUERIES, tokenizer_path
from geoloom.llm.secret_scan import RULES, trigram_query
from geoloom.llm.toxicity import fit_toxicity, score_toxicity

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, value):
    digits = [int(c) for c in value if c in "0123456789"]
    doubled = [d * 2 - 9 * (d > 4) if i % 2 else d for i, d in enumerate(reversed(digits))]
    return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in value.split(".")),
            "card": 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]


@pytest.mark.parametrize("letters", ["a@.b-", "01.2 -", "+1 ()-.2", "@a.1+ -(é", "0123456789 -."])
def test_anchored_spans_are_the_leftmost_matches(letters):
    finder, rng = Finder(), random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 45)))
        want = sorted((m.start(), KINDS.index(k), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if passes(k, m[0]))
        assert [s for s in finder.spans(text) if s[1] < 4] == want, text


def test_cues_and_schemes_are_found_in_any_case():
    finder = Finder()
    for text, value in (("User ID: 48213377", "48213377"), ("Customer Id 48213377.", "48213377"), ("İ CUSTOMER ID 48213377", "48213377"), ("uSER iD: 48213377", "48213377"),
                        ("HttpS://a.bc/D", "HttpS://a.bc/D"), ("at 12 Hill StReet", "12 Hill StReet"), ("12 Hill STRAßE", "12 Hill STRAßE"), ("12 Hill Straße", "12 Hill Straße")):
        assert value in [text[s:e] for s, k, e in finder.spans(text) if k >= 4], text


def test_trigram_queries_hold_for_every_match():
    samples = ["My PassWord = 'abcdefghijkl'", "api_key:abcdefghijklmnop", "APIKEY=abcdefghijklmn", "AKIA" + "A" * 16, "deadbeefdeadbeef",
               "-----BEGIN RSA PRIVATE KEY-----", "eyJ" + "a" * 12 + ".eyJ" + "b" * 12 + "." + "c" * 12, "ghp_" + "x" * 36]
    assert not trigram_query(RULES[2].pattern)
    for rule in RULES:
        matching = [s for s in samples if re.search(rule.pattern, s)]
        assert matching
        for s in matching:
            assert all(any(all(t in s.lower() for t in alternative) for alternative in clause) for clause in trigram_query(rule.pattern))


def edit_distance_to_run(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (a != b)))
    return min(row)


def test_edited_passages_are_found_with_the_promised_recall():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [[rng.choice(vocabulary) for _ in range(rng.randint(10, 60))] for _ in range(60)]
    texts, wanted = [], set()
    for d in range(400):
        m = rng.randrange(len(items))
        passage = list(items[m])
        for _ in range(rng.randint(0, len(passage) // 5)):
            at, kind = rng.randrange(len(passage)), rng.random()
            if kind < 0.5:
                passage[at] = rng.choice(vocabulary)
            elif kind < 0.75:
                passage.insert(at, rng.choice(vocabulary))
            else:
                del passage[at]
        texts.append([rng.choice(vocabulary) for _ in range(40)] + passage + [rng.choice(vocabulary) for _ in range(40)])
        if edit_distance_to_run(items[m], texts[-1]) <= len(items[m]) // 5:
            wanted.add((d, m))
    hashed = [next(decontaminate._words(pa.array([" ".join(i)]), 1))[2].hashes for i in items]
    search = decontaminate.Search(list(enumerate(hashed)))
    _, _, words = next(decontaminate._words(pa.array([" ".join(t) for t in texts]), 1 << 30))
    found = {(h[0], h[1]): h[2] for h in search.block(words)}
    assert len(wanted & found.keys()) >= 0.99 * len(wanted) and len(wanted) > 300
    for (d, m), distance in found.items():
        assert edit_distance_to_run(items[m], texts[d]) <= distance <= len(items[m]) // 5


@pytest.mark.parametrize("kind", ["replaced", "inserted", "deleted", "mixed"])
def test_long_passages_are_found_at_the_largest_distance(kind):
    rng = random.Random(11)
    for n in (8, 33, 40, 100, 200, 300):
        items = [[f"w{rng.randrange(2000)}" for _ in range(n)] for _ in range(25)]
        texts = []
        for item in items:
            passage = list(item)
            for i, at in enumerate(sorted(rng.sample(range(n), n // 5), reverse=True)):
                does = kind if kind != "mixed" else ("replaced", "inserted", "deleted")[i % 3]
                passage[at:at + 1] = {"replaced": [f"x{at}"], "inserted": [passage[at], f"x{at}"], "deleted": []}[does]
            texts.append([f"y{rng.randrange(2000)}" for _ in range(20)] + passage + [f"y{rng.randrange(2000)}" for _ in range(20)])
        hashed = [next(decontaminate._words(pa.array([" ".join(i)]), 1))[2].hashes for i in items]
        _, _, words = next(decontaminate._words(pa.array([" ".join(t) for t in texts]), 1 << 30))
        found = {(d, m) for d, m, distance, *_ in decontaminate.Search(list(enumerate(hashed))).block(words) if distance <= n // 5}
        assert sum((d, d) in found for d in range(25)) >= 24, n


def test_a_match_after_a_failed_candidate_is_searched_to_its_end(monkeypatch):
    item, other = [f"w{i}" for i in range(30)], [f"y{i}" for i in range(60)]
    passage = item[:12] + [f"x{i}" for i in range(6)] + item[12:]
    text = item[:20] + other[:22] + passage + other[30:]
    hashed, words = (next(decontaminate._words(pa.array([" ".join(t)]), 1))[2] for t in (item, text))
    monkeypatch.setattr(decontaminate.Search, "_starts", lambda *_: np.array([0, 42]))
    assert list(decontaminate.Search([(0, hashed.hashes)]).block(words)) == [(0, 0, 6, 42, 78)]


def test_a_match_starts_where_the_passage_starts():
    rng = random.Random(12)
    for trial in range(60):
        n = rng.randint(20, 60)
        item = [f"w{trial}x{i}" for i in range(n)]
        passage = list(item)
        for k in range(n // 5):
            passage.insert(rng.randint(n // 4, n // 2), f"x{k}")
        before, after = [f"b{i}" for i in range(rng.randint(0, 50))], [f"a{i}" for i in range(20)]
        hashed, words = (next(decontaminate._words(pa.array([" ".join(t)]), 1))[2] for t in (item, before + passage + after))
        assert decontaminate.best_match(hashed.hashes, words.hashes) == (n // 5, len(before), len(before) + len(passage))


def test_accounts_end_where_their_number_ends():
    finder = Finder()
    cases = {
        "account 48213377 was opened in May last year": ["48213377"], "the account 12 of 34567 units shipped": [], "user id 48213377 and then call": ["48213377"],
        "Customer ID: 4821 3377 is yours": ["4821 3377"], "acct no. AB123456 Then it rained": ["AB123456"], "account #12-3456-78, paid": ["12-3456-78"],
        "IBAN DE89 3704 0044 0532 0130 00 was used": ["DE89 3704 0044 0532 0130 00"], "iban GB29 NWBK 6016 1331 9268 19 THE BANK": ["GB29 NWBK 6016 1331 9268 19"],
        "passport number 123456789 A new one": ["123456789"], "account 1234": [], "accounts 48213377": [], "subaccount 48213377": [], "account " + "7" * 60 + " x": ["7" * 60],
    }
    for text, want in cases.items():
        assert [text[s:e] for s, k, e in finder.spans(text) if KINDS[k] == "account"] == want, text


def test_exact_edit_distance():
    rng = random.Random(8)
    for _ in range(300):
        item, text = ([rng.randrange(6) for _ in range(rng.randint(1, n))] for n in (20, 60))
        assert decontaminate.best_match(np.array(item), np.array(text))[0] == edit_distance_to_run(item, text)


def test_word_by_word_ids_are_those_of_the_whole_text():
    texts = ["It's the END, isn't it?! 12.5% e-mail@x.yz", "Émile ÉCOLE naïve café ß “quoted”… a b   x", "<|endoftext|> a<|endoftext|>b <|ENDOFTEXT|>", "", "日本語 текст 🙂🙂 a_b__c",
             "A--B//C don't DON'T 've 'll", "\x1c\x85 x\x00y"]
    tokens = Tokens(tokenizer_path())
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        ids, offsets = tokens.of_block(data, np.array([0, len(data)]))
        assert ids[offsets[0]:offsets[1]].tolist() == tokens.tokenizer.encode(t, add_special_tokens=False).ids, t


def test_a_pair_at_the_threshold_survives_an_unlucky_sketch():
    # 300 of 400 values are common, but only 44 of the smallest 84.
    low = [0] * 44 + [1] * 20 + [2] * 20
    random.Random(4).shuffle(low)
    side = np.array([*low, *[0] * 256, *[1] * 30, *[2] * 30])
    sets = [np.flatnonzero((side == 0) | (side == k)).astype(np.uint64) for k in (1, 2)]
    assert near_dedup._exact_links(sets, 75, None) and near_dedup._sketch_links(np.array([350, 350]), [s[:near_dedup.RETAINED] for s in sets], 75, None)


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)]
    parent = {x: x for link in links for x in link}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for link in links if link[0] != link[1] for x in link}


def test_small_blocks_give_the_same_rows(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = lambda df: sorted(map(tuple, df.collect()))
    near, repeats = rows(near_dedup.near_duplicates(docs)), rows(substring.repeated_words(docs))
    monkeypatch.setattr(near_dedup, "LIST_BLOCK", 2)
    monkeypatch.setattr(near_dedup, "GROUP_BLOCK", 500)
    assert rows(near_dedup.near_duplicates(docs)) == near
    assert rows(substring.repeated_words(docs, chunk_bytes=1 << 16, segment_windows=1 << 10)) == repeats
    top = rows(QUERIES["op10_top_k"](spark, sf_dir))
    for name, value in {"NODE": 40, "PAGE": 8, "BLOCK": 2}.items():
        monkeypatch.setattr(topk, name, value)
    assert rows(QUERIES["op10_top_k"](spark, sf_dir)) == top


def test_toxicity_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = fit_toxicity(docs, labels.filter("doc_id % 2 = 0"))
    assert list(model.thresholds) == sorted(model.thresholds)
    held_out = score_toxicity(docs.join(labels.filter("doc_id % 2 = 1").select("doc_id", "toxic"), "doc_id"), model).join(labels, "doc_id")
    counts = {(r.toxic, r.rejected): r["count"] for r in held_out.groupBy("toxic", "rejected").count().collect()}
    assert counts[1, True] >= 0.85 * (counts[1, True] + counts.get((1, False), 0)) and counts.get((0, True), 0) <= 0.01 * counts[0, False]
