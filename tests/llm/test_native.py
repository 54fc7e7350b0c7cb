"""Decontamination, shards, fingerprints and license scan against plain Python."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerlens.llm import decontam, imatch, licenses, shards
from ledgerlens.llm.licenses import template_words
from tests.llm.conftest import ODD, SF


def test_exact_leaks_and_nothing_else(spark, docs, texts):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [" ".join(template_words(r["text"])) for r in bench.collect()]
    expected = {k for k, t in texts.items() if any(f" {i} " in f" {' '.join(template_words(t))} " for i in items)}
    assert expected and {r["doc_id"] for r in decontam.contaminated(docs, bench).collect()} == expected
    left = decontam.decontaminate(docs, bench)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.select("doc_id").collect()} == set(texts) - expected


def test_substituted_tokens(spark):
    rng = random.Random(7)
    words = [f"w{k}" for k in range(3000)]
    items = [(k, " ".join(rng.sample(words, rng.randint(20, 50)))) for k in range(40)]
    rows, clean = [], []
    for k in range(200):
        own = [w if rng.random() > 0.12 else rng.choice(words) for w in items[k % 40][1].split()]
        rows.append((k, " ".join(rng.sample(words, 60) + own + rng.sample(words, 30))))
        clean.append((1000 + k, " ".join(rng.sample(words, 100))))
    bench = spark.createDataFrame([*items, (50, items[0][1]), (51, None), (52, "")], "item_id long, text string")
    found = {r["doc_id"]: r["item_id"] for r in decontam.contaminated(spark.createDataFrame(rows + clean, "doc_id long, text string"), bench).collect()}
    assert len(found) >= 198 and max(found) < 1000
    assert all(item == k % 40 for k, item in found.items())


def test_blocks_give_the_same(spark, docs, monkeypatch):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = {tuple(r) for r in decontam.contaminated(docs, bench).collect()}
    monkeypatch.setattr(decontam, "BLOCK_TOKENS", 700)
    assert {tuple(r) for r in decontam.contaminated(docs, bench).collect()} == whole


def test_items_without_an_id_of_their_own(spark):
    one, two, three = (" ".join(f"{a}{k}" for k in range(20)) for a in "abc")
    bench = spark.createDataFrame([(1, one), (1, two), (None, three), (None, one)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"x {one} y"), (2, f"x {two} y"), (3, f"x {three} y"), (4, f"{one} {two} {three}"), (5, "x y")], "doc_id long, text string")
    found = {r["doc_id"]: (r["n_items"], r["item_id"]) for r in decontam.contaminated(docs, bench).collect()}
    assert found == {1: (1, 1), 2: (1, 1), 3: (1, None), 4: (3, 1)}
    assert [r["doc_id"] for r in decontam.decontaminate(docs, bench).collect()] == [5]


def test_odd_rows_of_decontamination(spark, frame):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight"), (2, None)], "item_id long, text string")
    df = frame([*ODD, (11, "x one two three four five six seven eight y"), (11, "x")])
    left = decontam.decontaminate(df, bench)
    assert left.columns == df.columns and left.count() == len(ODD) + 1
    assert decontam.decontaminate(df, bench.limit(0)).count() == len(ODD) + 2
    assert decontam.decontaminate(frame([]), bench).count() == 0


def needed(item):
    """Tokens that must agree, and distinct ones among them, for an item shorter than a window."""
    return -(-len(item) * decontam.PERCENT // 100), min(decontam.LEAST_DISTINCT, len(set(item)))


def test_short_items_at_every_placement_of_substitutions(spark):
    items = {n: [f"i{n}w{k}" for k in range(n)] for n in range(1, 13)}
    items[20] = ["to", "be", "or", "not", "to", "be"]
    items[21] = ["so", "so"]
    docs, expected = [], {}
    for key, item in items.items():
        for wrong in range(len(item) + 1):
            for places in itertools.combinations(range(len(item)), wrong):
                if wrong > 4:
                    continue
                own = [f"x{key}z{i}" if i in places else w for i, w in enumerate(item)]
                agreeing = [w for i, w in enumerate(item) if i not in places]
                tokens, distinct = needed(item)
                docs.append((len(docs), " ".join(["before", "it", *own, "behind"])))
                if len(agreeing) >= tokens and len(set(agreeing)) >= distinct:
                    expected[docs[-1][0]] = key
    bench = spark.createDataFrame([(k, " ".join(v)) for k, v in items.items()], "item_id long, text string")
    found = {r["doc_id"]: r["item_id"] for r in decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert found == expected and set(expected.values()) == set(items)


def check_shards(df):
    rows = shards.assign_shards(df).collect()
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return rows, sizes


def test_shards(docs, texts):
    rows, sizes = check_shards(docs)
    mean, largest = sum(sizes.values()) / 40, max(r["size"] for r in rows)
    assert len(rows) == len(texts) and all(abs(s - mean) <= largest for s in sizes.values())
    where = defaultdict(set)
    for r in rows:
        text = texts[r["doc_id"]]
        assert (r["size"], r["text_crc32"]) == (len(text.encode()) + 16, zlib.crc32(text.encode()))
        where[text].add(r["shard"])
    assert sum(len(w) > 1 for w in where.values()) <= 2


def test_shards_of_a_hot_text(frame):
    rows, sizes = check_shards(frame([(k, "x" * 50 if k % 3 else f"y{k}" * 10) for k in range(3000)]))
    assert len(sizes) == 40 and max(sizes.values()) - min(sizes.values()) <= 4 * 66
    rows, _ = check_shards(frame(ODD))
    assert len(rows) == len(ODD)
    assert shards.assign_shards(frame([])).count() == 0


def test_edits_and_equal_texts(docs, texts):
    rows = imatch.fingerprints(docs).collect()
    order, prints = sorted(texts), defaultdict(set)
    after = dict(zip(order, [*order[1:], order[0]], strict=True))
    assert len(rows) == len(texts)
    for r in rows:
        text, head = texts[r["doc_id"]], texts[after[r["doc_id"]]]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + head[:quarter]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        prints[text].add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert all(len(p) == 1 for p in prints.values())
    assert sum(r["near_edited"] for r in rows) > 10 * sum(r["near_next"] for r in rows)


def test_lexicon_band(spark, docs, texts):
    n = Counter(w for t in texts.values() for w in set(template_words(t)))
    kept = {r["term"] for r in imatch.lexicon(docs, 0.01, 0.1).collect()}
    terms = [w for w, k in n.items() if 0.01 * len(texts) <= k <= 0.1 * len(texts)]
    hashed = spark.createDataFrame([(w,) for w in terms], "w string").select(F.xxhash64("w").alias("h")).collect()
    assert kept == {r["h"] for r in hashed}


def test_odd_rows_of_fingerprints(frame):
    rows = imatch.fingerprints(frame(ODD)).collect()
    assert len(rows) == len(ODD)
    assert len({r["fingerprint"] for r in rows if r["n_chars"] == 0}) == 1
    assert imatch.fingerprints(frame([])).count() == 0
    one = imatch.fingerprints(frame([(1, "a b c d")])).first()
    assert one["edited_sha256"] == hashlib.sha256(b"a b c a").hexdigest() and one["near_next"] == 1


def signed(data, seed=42):
    value = xxhash.xxh64(data, seed=seed).intdigest()
    return value - (1 << 64) if value >> 63 else value


def chained(values):
    """Hash of an array of longs: each entry's hash is the next one's seed."""
    seed = 42
    for v in values:
        seed = signed(v.to_bytes(8, "little", signed=True), seed % (1 << 64))
    return seed % (1 << 64)


def fingerprint(text, lexicon):
    """Level and subset hashes of a text, or the hash of all terms; by the definitions of the module's docstring."""
    terms = sorted({signed(w.encode()) for w in template_words(text)})
    level = 0
    while imatch.SUBSETS << (level + 1) < len(terms):
        level += 1
    known = [t for t in terms if t in lexicon]
    sets = []
    for j in range(level, level + imatch.LEVELS):
        thin = [t for t in known if (t % (1 << 64) >> 24) % (1 << j) == 0]
        sets += [[t for t in thin if t % imatch.SUBSETS == k] for k in range(imatch.SUBSETS)]
    least = [t for t in known if (t % (1 << 64) >> 24) % (1 << level) == 0]
    hashes = [f"{chained(x):016x}"[-imatch.DIGITS :] if x else "" for x in sets]
    return (level, hashes) if least else (None, [f"{chained(terms):016x}"])


def alike(a, b):
    if a == b:
        return 1.0
    if a[0] is None or b[0] is None or abs(a[0] - b[0]) >= imatch.LEVELS:
        return 0.0
    level = max(a[0], b[0])
    x, y = (p[1][(level - p[0]) * imatch.SUBSETS :][: imatch.SUBSETS] for p in (a, b))
    there = sum(p != "" or q != "" for p, q in zip(x, y, strict=True))
    return sum(p == q != "" for p, q in zip(x, y, strict=True)) / there if there else 0.0


@pytest.mark.parametrize("at_once", [imatch.LEXICON_AT_ONCE, 0])
def test_fingerprints_by_brute_force(docs, texts, monkeypatch, at_once):
    monkeypatch.setattr(imatch, "LEXICON_AT_ONCE", at_once)
    n = Counter(w for t in texts.values() for w in set(template_words(t)))
    lexicon = {signed(w.encode()) for w, k in n.items() if imatch.LOW * len(texts) <= k <= imatch.HIGH * len(texts)}
    order = sorted(texts)
    own = {k: fingerprint(texts[k], lexicon) for k in order}
    rows = {r["doc_id"]: r for r in imatch.fingerprints(docs).collect()}
    assert set(rows) == set(order)
    for k, after in zip(order, [*order[1:], order[0]], strict=True):
        quarter = len(texts[k]) // 4
        edited = fingerprint(texts[k][: len(texts[k]) - quarter] + texts[after][:quarter], lexicon)
        for p, name in ((own[k], "fingerprint"), (edited, "edited_fingerprint")):
            assert rows[k][name] == (f"all:{p[1][0]}" if p[0] is None else f"{p[0]}:{','.join(p[1])}")
        assert (rows[k]["near_edited"], rows[k]["near_next"]) == (alike(own[k], edited), alike(own[k], own[after]))


def test_next_document_of_repeated_and_missing_ids(frame, monkeypatch):
    monkeypatch.setattr(imatch, "task_count", lambda spark: 200)
    rows = [(None, f"n{k} a b c") for k in range(40)] + [(7, f"s{k} a b c") for k in range(60)] + [(k, f"d{k} a b c") for k in range(20)]
    out = imatch.neighbours(frame(rows).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")).collect()
    keys = sorted(out, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["row"]))
    assert len(out) == len(rows)
    assert all((r["next_row"], r["next_text"]) == (s["row"], s["text"]) for r, s in zip(keys, [*keys[1:], keys[0]], strict=True))


def phrase_places(words):
    found = []
    for label, phrase in licenses.PHRASES:
        own = phrase.split()
        found += [(i, label) for i in range(len(words) - len(own) + 1) if words[i : i + len(own)] == own]
    return found


def test_base_places(docs, texts):
    rows = licenses.scan(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        words = template_words(texts[r["doc_id"]])
        places = phrase_places(words)
        starts, labels = [i for i, _ in places], sorted({x for _, x in places})
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(words), len(places), min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(labels) and set(labels) <= set(r["labels"].split(","))


def test_worn_notices(spark, frame):
    notice = template_words(licenses.NOTICES[0][1])
    worn = notice[:9] + ["inserted"] + notice[9:14] + notice[15:]
    rows = [(1, " ".join(["x"] * 50 + worn + ["y"] * 20)), (2, " ".join(notice[:5])), (13, "cc by nc cc by nc under the MIT License"), *ODD]
    out = licenses.scan(frame(rows)).collect()
    assert len(out) == len(rows)
    by = {r["doc_id"]: r for r in out}
    assert by[1]["labels"] == "mit" and by[1]["n_base"] == 0 and 0.6 < by[1]["score"] < 1
    assert by[2]["labels"] == "" and by[2]["score"] < 0.5
    assert (by[13]["n_base"], by[13]["first_word"], by[13]["last_word"], by[13]["base_labels"]) == (3, 0, 6, "cc-by-nc,mit")
    assert by[5]["n_words"] == 0 and by[5]["first_word"] is None and by[5]["score"] == 0 and by[7]["n_words"] == 30000
    assert licenses.scan(frame([])).count() == 0


def license_scores(words):
    """Labels of accepted notices and the best share of any template: every diagonal, chains by trying all pairs of hits."""
    labels, score = set(), 0.0
    templates = [(x, t, True) for x, t in licenses.PHRASES] + [(x, t, False) for x, t in licenses.NOTICES]
    for label, text, base in templates:
        own = template_words(text)
        grams = [tuple(own[i : i + 3]) for i in range(len(own) - 2)]
        hits = [(p, t) for p in range(len(words) - 2) for t, g in enumerate(grams) if tuple(words[p : p + 3]) == g]
        for centre in {p - t for p, t in hits}:
            near = sorted(h for h in hits if abs(h[0] - h[1] - centre) <= licenses.NEIGHBOURS)
            best = []
            for p, t in near:
                best.append(1 + max((n for (q, u), n in zip(near, best, strict=False) if q < p and u < t), default=0))
            score = max(score, max(best) / len(grams))
            if not base and max(best) * 100 >= len(grams) * licenses.PERCENT:
                labels.add(label)
    return labels, score


def test_spans_are_verified(frame):
    notice = template_words(licenses.NOTICES[0][1])
    grams = [notice[i : i + 3] for i in range(len(notice) - 2)]
    backwards = [w for g in reversed(grams) for w in g]
    strewn = [w for g in grams for w in (*g, "and", "so")]
    rng, rows = random.Random(3), [(1, " ".join(backwards)), (2, " ".join(strewn)), (3, " ".join(notice * 3)), (4, "cc by nc " * 50)]
    for k in range(80):
        worn = []
        for w in template_words(rng.choice(licenses.NOTICES)[1]):
            luck = rng.random()
            worn += [] if luck < 0.06 else [w, rng.choice(notice)] if luck < 0.12 else [w]
        rows.append((10 + k, " ".join(["x"] * rng.randint(0, 5) + worn * rng.randint(1, 2) + ["y"])))
    out = {r["doc_id"]: r for r in licenses.scan(frame(rows)).collect()}
    assert out[1]["labels"] == out[2]["labels"] == "" and max(out[1]["score"], out[2]["score"]) < 0.3
    assert out[3]["labels"] == "mit" and out[3]["score"] == 1
    seen = set()
    for key, text in rows:
        labels, score = license_scores(template_words(text))
        base = {x for _, x in phrase_places(template_words(text))}
        assert (out[key]["labels"], out[key]["score"]) == (",".join(sorted(labels | base)), score)
        seen.add(bool(labels))
    assert seen == {True, False}
