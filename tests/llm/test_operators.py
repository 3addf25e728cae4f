"""The operators against brute force, on small tables with odd rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import __spark_entry__
import corpus_pipeline
import numpy as np
import pytest

from siltstone.llm import (
    cotraining,
    decontamination,
    hmm_score,
    html_text,
    licenses,
    near_duplicates,
    packing,
    quality_rules,
    toxicity,
    url_filter,
)

LABELS = "doc_id long, quality int, toxic int"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def byte_words(text):
    return (text or "").encode().lower().split()


def test_registered():
    names = set(__spark_entry__.queries())
    for number in range(1, 14):
        assert any(n.startswith(f"op{number}_") for n in names)
    assert "pipeline" in names


# 1


def shingle_set(text):
    words = byte_words(text)
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def brute_classes(rows):
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [shingle_set(r[1]) for r in rows]
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            same = (rows[i][1] or "") == (rows[j][1] or "")
            near = a and b and len(a & b) >= 0.8 * len(a | b)
            if same or near:
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    return sorted(sorted(map(str, g)) for g in groups.values())


def test_near_duplicates(odd, odd_rows):
    rows = near_duplicates.near_duplicates(odd).collect()
    assert len(rows) == len(odd_rows)
    groups = defaultdict(list)
    for r in rows:
        groups[r["class_id"]].append(str(r["doc_id"]))
    assert sorted(sorted(g) for g in groups.values()) == brute_classes(odd_rows)


def test_near_duplicates_of_the_tables(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = near_duplicates.near_duplicates(documents).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r["class_id"]].append(str(r["doc_id"]))
    given = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert sorted(sorted(g) for g in groups.values()) == brute_classes(given)


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(3)
    shared = rng.integers(0, 2**63, 400).astype(np.uint64)
    a = np.unique(np.concatenate([shared, rng.integers(0, 2**63, 100).astype(np.uint64)]))
    b = np.unique(np.concatenate([shared, rng.integers(0, 2**63, 100).astype(np.uint64)]))
    ones = [np.ones(len(a)), np.ones(len(b))]
    slots = near_duplicates.signatures([a, b], ones)
    assert abs((slots[0] == slots[1]).mean() - 400 / 600) < 0.1


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(90, 91)], "a long, b long")
    rows = {r["node"]: r["root"] for r in near_duplicates.components(links).collect()}
    assert rows == {i: 0 for i in range(1, 41)} | {91: 90}


# 2


def test_cotraining(spark, sf_dir, odd):
    # The smallest tables have too few bad rows to learn from.
    data = sf_dir.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{data}/labels.parquet")
    documents = spark.read.parquet(f"{data}/documents.parquet")
    rows = cotraining.score(documents, labels).collect()
    assert len(rows) == documents.count()
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    known = [(truth[r["doc_id"]], r["predicted"]) for r in rows if r["doc_id"] in truth]
    assert np.mean([a == b for a, b in known]) > 0.9
    none = cotraining.score(odd, spark.createDataFrame([], LABELS)).collect()
    assert {r["score"] for r in none} == {0.5}


def test_exchange_covers_all_unlabelled_texts(spark, sf_dir):
    """Over the rounds every distinct unlabelled text can be handed over, once."""
    data = sf_dir.replace("sf0.001", "sf0.01")
    documents = spark.read.parquet(f"{data}/documents.parquet")
    usable = cotraining._usable(spark.read.parquet(f"{data}/labels.parquet"))
    sample = cotraining._sample(documents, spark.read.parquet(f"{data}/labels.parquet"))
    sample = sample.withColumn("given", cotraining.F.lit(True)).cache()
    models = {v: cotraining._classifier(v, sample) for v in cotraining.VIEWS}
    every = {v: {1.0: (0.0, 1.0), 0.0: (0.0, 1.0)} for v in cotraining.VIEWS}
    parts = [
        cotraining._exchange(documents, usable, models, every, part).collect()
        for part in range(cotraining.ROUNDS)
    ]
    ids = [r["doc_id"] for part in parts for r in part]
    known = {r["doc_id"] for r in usable.collect()}
    texts = defaultdict(list)
    for r in documents.select("doc_id", "text").collect():
        if (r["text"] or "").strip(" ") and r["doc_id"] is not None and r["doc_id"] not in known:
            texts[r["text"]].append(r["doc_id"])
    assert sorted(ids) == sorted(min(of) for of in texts.values())
    assert all(parts)


def test_limits_take_the_share(spark, sf_dir):
    data = sf_dir.replace("sf0.001", "sf0.01")
    sample = cotraining._sample(*(spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels")))
    sample = sample.withColumn("given", cotraining.F.lit(True)).cache()
    for view in cotraining.VIEWS:
        model = cotraining._classifier(view, sample)
        for label, (limit, share) in cotraining._limits(sample, view, model).items():
            assert limit >= cotraining.SURE and 0 < share <= 1, label


def test_cotraining_of_odd_rows_with_labels(spark, odd):
    labels = spark.createDataFrame([(i, int(i > 6), None) for i in range(13)], LABELS)
    rows = cotraining.score(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)


# 3


@pytest.fixture(scope="module")
def encode():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_packing(odd, odd_rows, encode):
    rows = packing.pack(odd).collect()
    ids = defaultdict(list)
    for r in odd_rows:
        ids[r[0]].append(encode(r[1]))
    pieces = Counter((r["doc_id"], r["piece"]) for r in rows)
    for doc_id, found in ids.items():
        assert sum(n for (d, _), n in pieces.items() if d == doc_id) == sum(
            -(-len(x) // 2048) for x in found
        )
    sequences = defaultdict(list)
    for r in rows:
        whole = ids[r["doc_id"]][0]
        part = whole[r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
        assert r["length"] == 2048 or r["piece"] == 0
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(len(x) for found in ids.values() for x in found)
    assert len(sequences) == -(-total // 2048)


@pytest.mark.parametrize("text", ["a  b\n c", " x <|endoftext|> y", "tab\t  é\u2003ß .", "\n\n a", "it's 12 o'clock  "])
def test_ids_of_white_space(text, encode):
    ids = np.frombuffer(packing._encoder("byte_bpe_50k")(text), "<u4").tolist()
    assert [*ids, 0] == encode(text)


def test_evolution_beats_its_start():
    rng = np.random.default_rng(1)
    lengths = rng.integers(300, 1400, 200).tolist()
    start = packing._best_fit(list(range(200)), lengths, [], 2048)
    best = packing._evolve(lengths, [], 2048, 5)
    assert len(best) <= len(start)
    assert sorted(i for b in best for i in b) == list(range(200))
    assert all(sum(lengths[i] for i in b) <= 2048 for b in best)


def test_evolution_goes_on_while_it_saves_bins():
    """Threes that fill a bin exactly, where best fit is far from the optimum."""
    rng = np.random.default_rng(1)
    lengths = []
    for _ in range(100):
        long = int(rng.integers(780, 1000))
        middle = int(rng.integers(520, 1648 - long))
        lengths += [long, middle, 2048 - long - middle]
    start = packing._best_fit(list(range(300)), lengths, [], 2048)
    best = packing._evolve(lengths, [], 2048, 5)
    assert len(start) == 109
    assert len(best) <= 104
    assert sorted(i for b in best for i in b) == list(range(300))
    assert all(sum(lengths[i] for i in b) <= 2048 for b in best)


def test_blocks_keep_their_bound(spark, monkeypatch):
    """Pieces that never fill a bin go on from level to level, not into one block."""
    rng = np.random.default_rng(3)
    lengths = [1100] * 700 + rng.integers(20, 400, 1300).tolist()
    rows = [(i, 0, 0, int(n), 0) for i, n in enumerate(lengths)]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    monkeypatch.setattr(packing, "pieces", lambda *_: spark.createDataFrame(rows, schema))
    monkeypatch.setattr(packing, "BLOCK_PIECES", 100)
    sizes, pack_blocks = [], packing._pack_blocks

    def watched(*args):
        made = pack_blocks(*args)
        sizes.append(max(r["count"] for r in made.groupBy("block").count().collect()))
        return made

    monkeypatch.setattr(packing, "_pack_blocks", watched)
    packed = packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect()
    assert len(sizes) > 1 and max(sizes) < 200
    assert sorted(r["doc_id"] for r in packed) == list(range(2000))
    fills = defaultdict(int)
    for r in sorted(packed, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fills[r["sequence_id"]]
        fills[r["sequence_id"]] += r["length"]
    assert max(fills.values()) <= 2048
    whole = packing._best_fit(list(range(2000)), lengths, [], 2048)
    assert len(fills) <= 1.03 * len(whole)


# 4


def test_leaks_equal_brute_force(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(documents, benchmark).collect()}
    items = [(r["item_id"], decontamination.folded_words(r["text"].encode())) for r in benchmark.collect()]
    exact = set()
    for r in documents.collect():
        text = b" " + b" ".join(decontamination.folded_words((r["text"] or "").encode())) + b" "
        exact |= {(r["doc_id"], i) for i, words in items if b" " + b" ".join(words) + b" " in text}
    assert exact and exact <= found


def test_block_max_wand_equals_full_scoring():
    import random

    rng = random.Random(4)
    words = [b"w%d" % i for i in range(60)]
    items = [decontamination.Item(i, [rng.choice(words) for _ in range(12)], 8) for i in range(400)]
    frequency = Counter(w for i in items for w in set(i.words))
    index = decontamination.Index(items, frequency, 400, 12.0)
    for _ in range(30):
        terms = sorted(rng.sample(range(len(index.terms)), 25))
        scores = defaultdict(float)
        for t in terms:
            for n, x in zip(index.numbers[t], index.impacts[t], strict=True):
                scores[n] += x
        expected = {n for n, s in scores.items() if s >= decontamination.THRESHOLD}
        assert set(index.retrieve(terms)) == expected


def test_leaks_of_odd_rows(spark, odd, odd_rows):
    benchmark = spark.createDataFrame([(1, None), (2, ""), (None, "x y"), (3, odd_rows[5][1])], "item_id long, text string")
    found = Counter((r["doc_id"], r["item_id"]) for r in decontamination.leaks(odd, benchmark).collect())
    assert found == {(5, 3): 2, (6, 3): 1, (7, 3): 1}
    assert decontamination.filtered(odd, benchmark).columns == odd.columns


def test_items_in_several_indexes(spark, odd, odd_rows, monkeypatch):
    monkeypatch.setattr(decontamination, "INDEX_ITEMS", 2)
    texts = [odd_rows[5][1], odd_rows[9][1], "never seen words at all in here", "nor these ones"]
    benchmark = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(odd, benchmark).collect()}
    assert found == {(5, 0), (6, 0), (7, 0), (9, 1)}


# 5

PROSE = "A sentence with words, commas, and more words to read in this place."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        (f"<nav>menu</nav><article><h1>T &amp; U</h1><p>{PROSE}<p>x\n y<br>z</article><footer>f</footer>", f"T & U\n{PROSE}\nx y z"),
        (f"<div class='sidebar'><p>{PROSE}</p></div><div id=content><p>{PROSE}</p><ul><li>a</li><li>b</li></ul></div>", f"{PROSE}\na\nb"),
        (f"<article><p>{PROSE}</p><div class='ad'>buy</div><form><p>name</p></form></article><section class='comments'><p>{PROSE}</p></section>", PROSE),
        (f"<script>var t='</p>'</script><article><p>{PROSE}</p><script>x<", PROSE),
        (f"<header>h</header><main><p>{PROSE}</p><!-- no --><p>&lt;b&gt; &eacute;</p></main>", f"{PROSE}\n<b> é"),
        ("<article><p data-x=it's>first, one</p><p>second don't lose</p><p>third</p></article>", "first, one\nsecond don't lose\nthird"),
        ('<p title="a>text, more', "text, more"),
        (f"<div><div class=post>{PROSE}</div><div class=post>Short.</div><div class=post>{PROSE}</div></div>", f"{PROSE}\nShort.\n{PROSE}"),
        (f'<div class="search-results content"><p>{PROSE}</p></div>', PROSE),
        (f"<script src=x/>var a=1</script ><p>{PROSE}<!--></p>", PROSE),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("tag", ["div", "span", "b", "p", "li", "td", "section", "x-y"])
def test_deep_pages(tag):
    n = 20_000
    text = html_text.main_text(f"<{tag}>a, b " * n + "</i></li>" * n + "<p>end")
    # Nested containers compete, and the best one's text is kept; others lose nothing.
    found = text.split().count("b")
    assert found > 0 if tag in html_text.CONTAINERS else found == n and text.endswith("end")


@pytest.mark.parametrize("part", ['<p a="', "<p a='x> ", "<a ", "<!--", "<p a=b/ ", "<", "</", "<p =", "<script"])
def test_repeated_markup_ends(part):
    html_text.main_text(part * 50_000)


def test_extract_rows(spark):
    pages = spark.createDataFrame([(1, "u", None), (1, None, "<p>a, b</p>"), (None, "u", "x" * 9)], "page_id long, url string, html string")
    rows = {(r["page_id"], r["url"]): (r["text"], r["n_chars"]) for r in html_text.extract(pages).collect()}
    assert rows == {(1, "u"): ("", 0), (1, None): ("a, b", 4), (None, "u"): ("x" * 9, 9)}


# 6


def brute_quality(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    inside = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    repeated = len(lines) - len(set(lines))
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(inside), failed


def test_quality_measures(spark, sf_dir, odd):
    tables = spark.read.parquet(f"{sf_dir}/documents.parquet"), odd
    for documents in tables:
        texts = defaultdict(list)
        for r in documents.collect():
            texts[r["doc_id"]].append(brute_quality(r["text"]))
        rows = quality_rules.judge(documents).collect()
        assert len(rows) == documents.count()
        for r in rows:
            found = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
            assert found in texts[r["doc_id"]]
            assert not (r["base_failed"] and r["kept"])


def test_quality_agrees_with_labels(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = quality_rules.judge(documents).where("NOT base_failed").select("doc_id", "kept")
    known = judged.join(labels.withColumnRenamed("quality", "label"), "doc_id").collect()
    assert np.mean([r["kept"] == (r["label"] == 1) for r in known]) > 0.9
    assert quality_rules.filtered(documents).columns == documents.columns


def plain_maximisation(votes, rounds):
    """One text at a time, without vote patterns or logarithms."""
    prior, total = 0.8, len(votes)
    start = {-1: (0.3, 0.02), 1: (0.6, 0.8)}
    chances = [dict(start) for _ in votes[0]]
    weight = max(1.0, 0.01 * total)
    stay = (weight * (1 - prior), weight * prior)
    for _ in range(rounds):
        sides = [0.0, 0.0]
        sums = [{v: [start[v][c] * stay[c] for c in (0, 1)] for v in start} for _ in votes[0]]
        for text in votes:
            like = [1 - prior, prior]
            for rule, vote in enumerate(text):
                if vote:
                    like = [like[c] * chances[rule][vote][c] for c in (0, 1)]
            share = [x / sum(like) for x in like]
            for c in (0, 1):
                sides[c] += share[c]
                for rule, vote in enumerate(text):
                    if vote:
                        sums[rule][vote][c] += share[c]
        chances = [
            {v: tuple(min(max(rule[v][c] / (sides[c] + stay[c]), 1e-4), 1 - 1e-4) for c in (0, 1)) for v in rule}
            for rule in sums
        ]
        prior = min(max((sides[1] + stay[1]) / (total + weight), 0.01), 0.99)
    return prior, chances


def made_votes(texts, seed):
    """Votes of rules with known rates, and which of the texts are good."""
    rng = random.Random(seed)
    good = [rng.random() < 0.7 for _ in range(texts)]
    votes = []
    for g in good:
        fired = [rng.random() < (0.03 if g else 0.5) for _ in quality_rules.RULES]
        spoken = [rng.random() < (0.8 if g else 0.3) for _ in quality_rules.RULES]
        votes.append(tuple(-1 if f else 1 if s else 0 for f, s in zip(fired, spoken, strict=True)))
    return votes, good


@pytest.mark.parametrize("rounds", [1, 7])
def test_maximisation_equals_brute_force(rounds):
    votes, _ = made_votes(150, 1)
    patterns = Counter(votes)
    model = quality_rules.fit(np.array(list(patterns)), np.array(list(patterns.values()), float), rounds)
    prior, chances = plain_maximisation(votes, rounds)
    assert abs(model.prior - prior) < 1e-9
    for found, plain in zip(model.chances, chances, strict=True):
        for i, vote in enumerate(quality_rules.VOTES):
            assert np.allclose(found[:, i], plain[vote])


def test_maximisation_finds_the_rates():
    votes, good = made_votes(4000, 2)
    patterns = Counter(votes)
    model = quality_rules.fit(np.array(list(patterns)), np.array(list(patterns.values()), float))
    assert abs(model.prior - sum(good) / len(good)) < 0.03
    assert np.allclose(model.chances[:, 0, 0], 0.5, atol=0.06)
    assert np.allclose(model.chances[:, 1, 0], 0.03, atol=0.02)


def test_maximisation_without_texts():
    rules = len(quality_rules.RULES)
    model = quality_rules.fit(np.zeros((0, rules), int), np.zeros(0))
    assert model.prior == 0.8 and model.chances.shape == (rules, 2, 2)


# 7


def brute_url(url):
    found = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = found.groups() if found else ("", "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h + p), h + p, v)
        for h, p, v in url_filter.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_url_rules(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    odd = [(-1, None), (-2, "no scheme/en/"), (-3, "HTTP://WWW.Example.COM/en/x?y"), (-4, "a://xcom/"), (-5, "a://b.net/fr/"), (-6, "a://b.com"), (-7, "x://y/é#://"), (-7, "x://y/é#://")]
    rows = url_filter.judge(pages.union(spark.createDataFrame(odd, pages.schema))).collect()
    urls = {r["page_id"]: r["url"] for r in pages.collect()} | dict(odd)
    assert len(rows) == len(urls) + 1
    for r in rows:
        host, path, rule, verdict = brute_url(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or r["verdict"]) and r["verdict"] in ("allow", "block")


def test_url_filter_without_labels(spark):
    pages = spark.createDataFrame([(1, "a://b.org/x")], "page_id long, url string")
    assert [r["verdict"] for r in url_filter.judge(pages).collect()] in (["allow"], ["block"])


def test_suffix_statistics_are_of_all_rows(spark, monkeypatch):
    """Also of rows without a rule and of those the trees are not fitted on."""
    monkeypatch.setattr(url_filter, "FIT_ROWS", 10)
    given = [("org", "/es/", None)] * 40 + [("net", "/es/", 1.0)] * 80 + [("com", "/es/", 0.0)] * 60 + [("net", "/de/", None)] * 19 + [("io", "/es/", None)]
    rows = [(i, f"a://h{i}.{s}{d}", f"h{i}.{s}", d, y) for i, (s, d, y) in enumerate(given)]
    ruled = spark.createDataFrame(rows, "page_id int, url string, host string, path string, label double")
    found = {r["page_id"]: r for r in url_filter.with_suffixes(ruled).collect()}
    assert len(found) == 200
    whole = 80.5 / 141
    es = (80 + 20 * whole) / 160
    unlabelled = {("org", "/es/"): es, ("net", "/de/"): whole, ("io", "/es/"): es}
    for i, (suffix, directory, label) in enumerate(given):
        r = found[i]
        assert r["suffix_share"] == (0.005 if suffix == "io" else 0.01)
        if label is None:
            assert abs(r["suffix_rate"] - unlabelled[suffix, directory]) < 1e-12
        else:  # without the rows of its own fold
            own = (given.count((suffix, directory, label)) * label + 20 * es) / (20 + given.count((suffix, directory, label)))
            assert abs(r["suffix_rate"] - label) > abs(own - label)


def test_a_suffix_alone_does_not_block(spark, sf_dir):
    """The rules only block ``net``; its pages unlike all blocked ones are allowed."""
    pages = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/pages.parquet")
    rows = [(r, r["path"].split("/")[1]) for r in url_filter.judge(pages).collect()]
    blocked = {d for r, d in rows if r["rule"] and r["verdict"] == "block"}
    free = [r["verdict"] for r, d in rows if r["rule"] is None and r["host"].endswith(".net") and d not in blocked]
    assert free and free.count("block") < len(free) / 10


# 8


def test_scores(spark, sf_dir, odd, odd_rows):
    for documents in (spark.read.parquet(f"{sf_dir}/documents.parquet"), odd):
        given = [(r["doc_id"], byte_words(r["text"]) + [b""]) for r in documents.collect()]
        counts = Counter()
        for doc_id, words in given:
            if not hmm_score.held_out(doc_id):
                counts.update(words)
        total, distinct = sum(counts.values()), len(counts)
        expected = defaultdict(list)
        for doc_id, words in given:
            base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
            expected[doc_id].append((len(words), sum(counts[w] > 0 for w in words), base))
        rows = hmm_score.score(documents).collect()
        assert len(rows) == len(given)
        for r in rows:
            assert r["train_tokens"] == total
            assert any(
                (r["n_tokens"], r["n_known"]) == e[:2] and abs(r["base_score"] - e[2]) < 1e-6
                for e in expected[r["doc_id"]]
            )
            assert math.isfinite(r["score"])
    held = [r for r in rows if r["held_out"]]
    assert held


def test_forward_equals_all_paths(monkeypatch):
    monkeypatch.setattr(hmm_score, "STATES", 2)
    rng = np.random.default_rng(2)
    emits = rng.random((5, 2))
    model = hmm_score.Model(np.array([0.3, 0.7]), np.array([[0.6, 0.4], [0.2, 0.8]]), emits / emits.sum(axis=0))
    texts = [[0, 1, 2], [3], [4, 4, 0, 2, 1]]
    classes = np.array([c for t in texts for c in t], np.uint16)
    found = hmm_score.log_likelihoods(model, classes, np.array([len(t) for t in texts]))
    import itertools

    for text, value in zip(texts, found, strict=True):
        total = 0.0
        for path in itertools.product(range(2), repeat=len(text)):
            p = model.start[path[0]] * model.emits[text[0], path[0]]
            for i in range(1, len(text)):
                p *= model.moves[path[i - 1], path[i]] * model.emits[text[i], path[i]]
            total += p
        assert abs(value - math.log10(total)) < 1e-9


def test_scores_without_training_texts(spark):
    ids = [i for i in range(40) if hmm_score.held_out(i)]
    rows = [(i, t) for i, t in zip(ids, ["a b a", None, "", "c"], strict=False)]
    found = hmm_score.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in found} == dict(zip(ids, [4, 1, 1, 2], strict=False))
    for r in found:
        assert r["held_out"] and (r["n_known"], r["train_tokens"], r["base_score"]) == (0, 0, 0.0)
        assert math.isfinite(r["score"]) and r["score"] < 0


@pytest.mark.parametrize("group", [1, 4, 100])
def test_expected_counts_equal_all_paths(monkeypatch, group):
    monkeypatch.setattr(hmm_score, "STATES", 2)
    monkeypatch.setattr(hmm_score, "CLASSES", 5)
    monkeypatch.setattr(hmm_score, "GROUP_TOKENS", group)
    rng = np.random.default_rng(3)
    emits = rng.random((5, 2))
    model = hmm_score.Model(np.array([0.3, 0.7]), np.array([[0.6, 0.4], [0.2, 0.8]]), emits / emits.sum(axis=0))
    texts = [[0, 1, 2], [3], [4, 4, 0, 2, 1], [3]]
    classes = np.array([c for t in texts for c in t], np.uint16)
    found = hmm_score.expected_counts(model, classes, np.array([len(t) for t in texts]))
    import itertools

    begun, moved, emitted = np.zeros(2), np.zeros((2, 2)), np.zeros((5, 2))
    for text in texts:
        chances = {}
        for path in itertools.product(range(2), repeat=len(text)):
            p = model.start[path[0]] * model.emits[text[0], path[0]]
            for i in range(1, len(text)):
                p *= model.moves[path[i - 1], path[i]] * model.emits[text[i], path[i]]
            chances[path] = p
        total = sum(chances.values())
        for path, p in chances.items():
            begun[path[0]] += p / total
            for i, state in enumerate(path):
                emitted[text[i], state] += p / total
                if i:
                    moved[path[i - 1], state] += p / total
    assert np.allclose(found, np.concatenate([begun, moved.ravel(), emitted.ravel()]))


# 9


def test_toxicity(spark, sf_dir):
    data = sf_dir.replace("sf0.001", "sf0.01")
    documents = spark.read.parquet(f"{data}/documents.parquet")
    labels = spark.read.parquet(f"{data}/labels.parquet")
    rows = toxicity.score(documents, toxicity.fit(documents, labels)).collect()
    assert len(rows) == documents.count()
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    known = [(truth[r["doc_id"]], r["predicted"]) for r in rows if r["doc_id"] in truth]
    assert np.mean([a == b for a, b in known]) > 0.85
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_only_copies_are_dropped(spark):
    """Texts that share one common pair are fitted each, near copies once."""
    rng = np.random.default_rng(4)
    texts = [f"the of {' '.join(f'w{x}' for x in rng.integers(0, 10**9, 9))}" for _ in range(300)]
    base = [f"c{x}" for x in range(100)]
    near = [" ".join([*base[:i], "changed", *base[i + 1 :]]) for i in range(0, 100, 5)]
    rows = [(0, t) for t in texts] + [(0, t) for t in near] + [(1, near[0]), (1, near[0]), (1, None)]
    sample = spark.createDataFrame(rows, "toxic int, text string")
    kept = Counter(r["toxic"] for r in toxicity._fitted_rows(sample).collect())
    assert kept == {0: 301, 1: 2}


def test_toxicity_without_labels(spark, odd):
    model = toxicity.fit(odd, spark.createDataFrame([], LABELS))
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == odd.count() and {r["predicted"] for r in rows} == {0}
    assert toxicity.filtered(odd, model).columns == odd.columns


# 10


def test_licenses(spark, odd):
    texts = ["The MIT License, and mit-license; Apache License 2.0", "mit license mit license", "GNU General Public License, version 3 or later", "amit license", None]
    more = [(100 + i, t, None, None, None, None, None, None) for i, t in enumerate(texts)]
    documents = odd.union(spark.createDataFrame(more, odd.schema))
    given = {r["doc_id"]: r["text"] for r in documents.collect()}
    low = str.maketrans(licenses.CAPITALS, licenses.SMALL)
    for r in licenses.scan(documents).collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (given[r["doc_id"]] or "").translate(low))
        places, labels = [], set()
        for phrase, label in licenses.PHRASES.items():
            parts = phrase.split()
            at = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
            places += at
            labels |= {label} if at else set()
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert r["first_word"] == min(places, default=None)
        assert r["last_word"] == max(places, default=None)
        assert r["base_labels"] == ",".join(sorted(labels))
        assert labels <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        for d in r["detections"]:
            text = " " + "  ".join(words[d["start"] : d["end"]]) + " "
            pattern = licenses.RULES[d["rule"]]["pattern"]
            assert re.fullmatch(pattern, text)
    found = {r["doc_id"]: r["labels"] for r in licenses.scan(documents).collect()}
    assert found[102].split(",") == ["gpl", "gpl-3-or-later"]


#: Texts as they are met, and the label that the rules must give them.
LICENSE_SAMPLES = [
    ("GPLv2", "gpl-2"),
    ("GPL v2", "gpl-2"),
    ("General Public License v2.0", "gpl-2"),
    ("GNU GPL version 3", "gpl-3"),
    ("the LGPLv2.1", "lgpl-2.1"),
    ("GNU Affero General Public License, Version 3.0", "agpl-3"),
    ("it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "gpl-2-or-later"),
    ("SPDX-License-Identifier: GPL-2.0-or-later", "gpl-2-or-later"),
    ("SPDX-License-Identifier: LGPL-2.1-only", "lgpl-2.1"),
    ("// SPDX-License-Identifier: MIT", "mit"),
    ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"),
    ("SPDX-License-Identifier: CC-BY-SA-4.0", "cc-by-sa-4.0"),
    ("Apache License v2.0", "apache-2.0"),
    ('Licensed under the Apache License, Version 2.0 (the "License")', "apache-2.0"),
    ("http://www.apache.org/licenses/LICENSE-2.0", "apache-2.0"),
    ("Mozilla Public License, v. 2.0", "mpl-2.0"),
    ("EPL-2.0", "epl-2.0"),
    ("MS-PL", "ms-pl"),
    ("3-Clause BSD License", "bsd-3-clause"),
    ("Redistributions in binary form must reproduce the above copyright notice", "bsd"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "cc-by-nc-sa-4.0"),
    ("https://creativecommons.org/licenses/by-nd/3.0/", "cc-by-nd-3.0"),
    ("Boost Software License - Version 1.0", "bsl-1.0"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("SIL Open Font License, Version 1.1", "ofl-1.1"),
    ("GNU Free Documentation License, Version 1.3 or any later version", "gfdl-1.3-or-later"),
]


def test_license_samples(spark):
    texts = [(i, f"so {t} it is") for i, (t, _) in enumerate(LICENSE_SAMPLES)]
    clean = ["the mitigation of generals", "licensed drivers only", "a public good", "later versions of the story"]
    texts += [(100 + i, t) for i, t in enumerate(clean)]
    found = licenses.scan(spark.createDataFrame(texts, "doc_id long, text string"))
    labels = {r["doc_id"]: r["labels"].split(",") for r in found.collect()}
    for i, (text, label) in enumerate(LICENSE_SAMPLES):
        assert label in labels[i], text
    assert [labels[100 + i] for i in range(len(clean))] == [[""]] * len(clean)


def test_every_license_rule_detects_its_wording(spark):
    """Written without its optional words and choices' first spelling, a rule is hit."""
    plain = [re.sub(r"\(\?:[^()]*(?:\([^()]*\))?[^()]*\)\?", "", r["pattern"]) for r in licenses.RULES]
    plain = [re.sub(r"\[(.)[^]]*\]", r"\1", p).replace("v?", "v") for p in plain]
    plain = [re.sub(r"\(([^|()]*)[^()]*\)", r"\1", p) for p in plain]
    texts = spark.createDataFrame(list(enumerate(plain)), "doc_id long, text string")
    for r in licenses.scan(texts).collect():
        rule = licenses.RULES[r["doc_id"]]
        assert re.fullmatch(rule["pattern"], plain[rule["rule"]])
        better = [d for d in r["detections"] if d["priority"] >= rule["priority"]]
        assert better, rule


def brute_detections(text):
    words = " " + "  ".join(text.lower().split()) + " "
    found = []
    for r in licenses.RULES:
        at = 0
        while match := re.compile(r["pattern"]).search(words, at):
            start = words[: match.start()].count(" ") // 2 if match.start() else 0
            size = len(match.group().split())
            found.append((start, start + size, r["priority"], r["rule"]))
            at = match.end()
    kept = []
    for s, e, p, rule in found:
        over = [o for o in found if o[0] <= s and o[1] >= e and o[3] != rule]
        if not any(o[2] >= p if o[1] - o[0] > e - s else (o[2], -o[3]) > (p, -rule) for o in over):
            kept.append((rule, s, e))
    return sorted(kept)


def test_detections_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(licenses, "SWEEP_BLOCK", 3)
    rng = random.Random(8)
    parts = [t.lower() for t, _ in LICENSE_SAMPLES] + ["or later", "version 2", "gnu", "mit", "x"]
    texts = [" ".join(re.findall("[a-z0-9]+", " ".join(rng.choices(parts, k=rng.randrange(1, 12))))) for _ in range(40)]
    rows = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    for r in rows.collect():
        got = sorted((d["rule"], d["start"], d["end"]) for d in r["detections"])
        assert got == brute_detections(texts[r["doc_id"]])


def test_many_places_in_one_text(spark):
    one = spark.createDataFrame([(1, "gnu gpl " * 20_000)], "doc_id long, text string")
    row = licenses.scan(one).first()
    assert len(row["detections"]) == 20_000 and row["labels"] == "gpl"


# All


def test_empty_tables(spark, empty):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], LABELS)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    results = [
        near_duplicates.near_duplicates(empty),
        cotraining.score(empty, labels),
        packing.pack(empty),
        decontamination.leaks(empty, benchmark),
        html_text.extract(pages),
        quality_rules.judge(empty),
        url_filter.judge(pages),
        hmm_score.score(empty),
        toxicity.score(empty, toxicity.fit(empty, labels)),
        licenses.scan(empty),
    ]
    for result in results:
        assert result.collect() == []


def test_pipeline_stages(spark, sf_dir, encode):
    """Each stage against what its operator says of its own input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = corpus_pipeline.staged(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert after.items() <= before.items() and after
        if name == "near_duplicates":
            kept = brute_classes(list(after.items()))
            assert all(len(g) == 1 for g in kept)
            assert len(kept) == len(brute_classes(list(before.items())))
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert sum(r["length"] for r in rows) == sum(len(encode(t)) for t in after.values())


def test_pipeline_keeps_odd_columns(odd, spark, sf_dir):
    kept = quality_rules.filtered(odd)
    assert kept.columns == odd.columns
    assert near_duplicates.filtered(odd).columns == odd.columns
    texts = [r["text"] or "" for r in near_duplicates.filtered(odd).collect()]
    assert len(texts) == len(set(texts))
