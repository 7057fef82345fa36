"""Every operator against a plain version over a small table of awkward rows."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import pytest

from kestrel.llm import best_fit, chunked_bpe, grace_dedup, html_layout, isolation_rules, kd_shards, overlap_join, substring_dedup, surrogates, token_files
from kestrel.llm.common import text_slices
from tests.llm.conftest import ROWS

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def words(text):
    return WORD.findall(text or "")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def got(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def key(doc_id):
    return (doc_id is None, doc_id or 0)


def test_substring_dedup(docs, empty):
    first = {}
    for i, t in ROWS:
        w = words(t)
        for p in range(len(w) - 49):
            k = tuple(w[p:p + 50])
            first[k] = min(first.get(k, key(i)), key(i))
    expected = Counter()
    for i, t in ROWS:
        w = words(t)
        covered = [False] * len(w)
        for p in range(len(w) - 49):
            if first[tuple(w[p:p + 50])] < key(i):
                covered[p:p + 50] = [True] * 50
        kept = [x for x, c in zip(w, covered) if not c]
        expected[i, len(w), len(w) - len(kept), sha(" ".join(kept).encode())] += 1
    assert got(substring_dedup.substring_dedup(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == expected
    assert substring_dedup.substring_dedup(empty).count() == 0


def _ids():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORD_BPE)
    return [t.encode(x or "", add_special_tokens=False).ids for _, x in ROWS]


def test_token_files(spark, docs, empty):
    out = token_files.token_files(spark, docs, tokenizer=WORD_BPE, end_id=1).collect()
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in out) == Counter(
        (i, len(ids) + 1, crc([*ids, 1])) for (i, _), ids in zip(ROWS, _ids()))
    at, last = 0, None
    for r in sorted(out, key=lambda r: r["start"]):
        assert r["start"] == at and (last is None or r["doc_id"] is not None and r["doc_id"] >= last)
        at, last = at + r["n_tokens"], r["doc_id"]
    assert token_files.token_files(spark, empty, tokenizer=WORD_BPE, end_id=1).count() == 0


@pytest.mark.parametrize("per_stream", [100_000, 20])
def test_best_fit(docs, empty, per_stream):
    out = best_fit.best_fit_packing(docs, tokenizer=WORD_BPE, end_id=0, capacity=512, open_bins=4, per_stream=per_stream).collect()
    expected = Counter()
    for (i, _), ids in zip(ROWS, _ids()):
        ids = [*ids, 0]
        for p in range(0, len(ids), 512):
            part = ids[p:p + 512]
            expected[i, p // 512, p, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == expected
    bins = defaultdict(list)
    for r in out:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 512
    least = -(-sum(r["length"] for r in out) // 512)
    assert len(bins) <= 1.15 * least + 1
    assert best_fit.best_fit_packing(empty, tokenizer=WORD_BPE, end_id=0).count() == 0


def test_best_fit_closes_the_fullest():
    bins = best_fit.BestFit(10, 2)
    assert bins.put(6, "a") is None and bins.put(7, "b") is None
    assert bins.put(3, "c") == (1, [("b", 0), ("c", 7)])  # the tightest fit
    assert bins.put(5, "d") is None
    assert bins.put(8, "e") == (3, [("e", 0)])  # one bin too many: the fullest closes


@pytest.mark.parametrize(("chunk", "overlap"), [(chunked_bpe.CHUNK, chunked_bpe.OVERLAP), (64, 16)])
def test_chunked_bpe(docs, empty, chunk, overlap):
    import tiktoken

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks, "rb"))}
    enc = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    expected = Counter()
    for i, t in ROWS:
        ids = enc.encode_ordinary(t or "")
        expected[i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((t or "").encode())] += 1
    run = lambda d: chunked_bpe.chunked_bpe(d, ranks=ranks, pattern=public_tokenizers.PATTERN, chunk=chunk, overlap=overlap)
    assert got(run(docs), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == expected
    assert run(empty).count() == 0


@pytest.mark.parametrize("table_bytes", [64 << 20, 500])
def test_grace_dedup(docs, empty, table_bytes):
    groups = defaultdict(list)
    for i, t in ROWS:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), key(i), i))
    expected = Counter()
    for norm, rows in groups.items():
        rows.sort(key=lambda r: r[:2])
        for n, (_, _, i) in enumerate(rows):
            expected[i, rows[0][2], len(rows), n == 0, sha(norm.encode())] += 1
    out = grace_dedup.grace_dedup(docs, table_bytes=table_bytes)
    assert got(out, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == expected
    assert grace_dedup.grace_dedup(empty).count() == 0


def test_content_table_compares_contents():
    table = grace_dedup.ContentTable(slots=2)
    assert [table.find_or_add(1, c) for c in ("a", "b", "a", "c", "b")] == [(0, True), (1, True), (0, False), (2, True), (1, False)]


def test_kd_shards(docs, empty):
    out = kd_shards.kd_shards(docs.where("doc_id is null or doc_id not in (25, 52)"), dims=["n_chars", "doc_id", "lang", "source"], shards=4).collect()
    rows = [(i, t) for i, t in ROWS if i not in (25, 52)]
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    by = defaultdict(list)
    for r in out:
        by[r["shard"]].append(r)
    assert sorted(by) == [0, 1, 2, 3]
    for rows_ in by.values():
        assert sorted(r["slot"] for r in rows_) == list(range(len(rows_)))
    sizes = [sum(r["size"] for r in x) for x in by.values()]
    assert max(sizes) - min(sizes) <= 2 * max(len((t or "").encode()) + 1 for _, t in rows)
    assert kd_shards.kd_shards(empty, dims=["n_chars", "lang"]).count() == 0


def test_isolation_rules(spark, docs, empty):
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)] + [(None, 1), (3, None)], "doc_id long, quality int")
    out = isolation_rules.quality_rules(docs, labels, trees=20)
    expected = Counter()
    for i, t in ROWS:
        w, lines = words(t), [x for x in (t or "").split("\n") if words(x)]
        runs = Counter(zip(w, w[1:], w[2:]))
        again = {p + k for p, r in enumerate(zip(w, w[1:], w[2:])) if runs[r] > 1 for k in range(3)}
        expected[i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(again),
                 len(w) < 50 or 100 * len(again) > 50 * len(w)] += 1
    assert got(out, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == expected
    assert out.where("base_failed and kept").count() == 0
    assert isolation_rules.quality_rules(empty, labels).count() == 0
    unlabelled = isolation_rules.quality_rules(docs, labels.where("1 = 0"))
    assert unlabelled.where("kept = base_failed").count() == 0


def test_isolation_forest_tells_bad_rows_apart(spark):
    """Held-out labels: half of the labelled rows set the threshold, the other half are judged."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").groupBy("doc_id").min("quality").toDF("doc_id", "quality")
    out = isolation_rules.quality_rules(docs, labels.where("pmod(xxhash64(doc_id), 2) = 0"))
    held = out.join(labels.where("pmod(xxhash64(doc_id), 2) = 1"), "doc_id").where("not base_failed").toPandas()
    good, bad = held[held.quality > 0], held[held.quality == 0]
    assert good.kept.mean() > 0.98
    assert bad.kept.mean() < 0.4


@pytest.mark.parametrize("half", [0, 1])
def test_isolation_forest_finds_plain_junk(spark, half):
    """Held-out labels, either half: hardly a bad row stays and hardly a good one goes."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").groupBy("doc_id").min("quality").toDF("doc_id", "quality")
    out = isolation_rules.quality_rules(docs, labels.where(f"pmod(xxhash64(doc_id), 2) = {half}"))
    held = out.join(labels.where(f"pmod(xxhash64(doc_id), 2) = {1 - half}"), "doc_id").where("not base_failed").toPandas()
    good, bad = held[held.quality > 0], held[held.quality == 0]
    assert len(bad) > 100 and bad.kept.mean() < 0.02
    assert good.kept.mean() > 0.99



def test_quality_rules_learn_from_all_labelled_rows(spark):
    """Range, trees and scores counted over every labelled row, against numpy over the same rows."""
    rng = np.random.default_rng(3)
    counts = [[int(v) for v in rng.integers(50, 400, 8)] for _ in range(23_000)]
    good = [bool(v) for v in rng.random(len(counts)) < 0.8]
    names = isolation_rules._COUNTS
    labelled = spark.createDataFrame([(i, i, *c, g) for i, (c, g) in enumerate(zip(counts, good))],
                                     "__doc long, __row long, " + ", ".join(f"{c} long" for c in names) + ", good boolean").repartition(3)
    x = isolation_rules.rule_ratios({c: np.array(counts)[:, i] for i, c in enumerate(names)})
    n = sum(good)
    limits = isolation_rules.good_limits(labelled.where("good"), n, 0.1)
    assert limits.tolist() == np.quantile(x[np.array(good)], 1 - 0.1 / 7, axis=0, method="higher").tolist()
    forest = isolation_rules.IsolationForest.fit(labelled, limits, n, len(good) - n, trees=8, draw=64, bad_share=0.01, seed=1)
    assert len(forest.trees) == 8 and abs(8 * forest.size - 1.01 * n) < 1e-6  # a row in one tree each, the bad ones 1 % of the good
    score, has_good, has_bad = isolation_rules.score_counts(labelled, forest, limits)
    assert (has_good.sum(), has_bad.sum()) == (n, len(good) - n)
    assert Counter(forest.score(isolation_rules.excess(x, limits)).tolist()) == Counter(dict(zip(score.tolist(), (has_good + has_bad).tolist())))



def test_sketches_leave_few_pairs_to_compare(spark, monkeypatch):
    """Sets put together from the same passages share many shingles, but few of them enough for a link: few pairs are compared in full."""
    rng = np.random.default_rng(11)
    passages = [" ".join(f"w{p}x{i}" for i in range(25)) for p in range(14)]
    texts = [" ".join(passages[p] for p in sorted(rng.choice(14, 9, replace=False))) for _ in range(120)]
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    near = [[100 * len(a & b) >= 75 * len(a | b) for b in sets] for a in sets]
    linked = sum(near[i][j] for i in range(120) for j in range(i) if sets[i] != sets[j])
    compared, real = [], overlap_join._linked

    def counted(pairs, *rest):
        compared.append(pairs.select("a", "b").distinct().count())
        return real(pairs, *rest)

    monkeypatch.setattr(overlap_join, "_linked", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r["component_id"] for r in overlap_join.near_duplicates(docs, hub_rounds=0).collect()}
    assert compared[0] <= 2 * linked + 20
    component = list(range(120))
    for _ in range(120):
        component = [min(component[j] for j in range(120) if near[i][j]) for i in range(120)]
    assert out == dict(enumerate(component))


def test_overlap_join(docs, empty, monkeypatch):
    low = lambda t: re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    sets = []
    for _, t in ROWS:
        w = words(low(t))
        sets.append({tuple(w[p:p + 5]) for p in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    leader = {i: i for i, _ in ROWS if i is not None}

    def top(i):
        while leader[i] != i:
            i = leader[i]
        return i

    for a, (i, _) in enumerate(ROWS):
        for b, (j, _) in enumerate(ROWS[:a]):
            if i is not None and j is not None and sets[a] and sets[b]:
                o = len(sets[a] & sets[b])
                if 100 * o >= 75 * (len(sets[a]) + len(sets[b]) - o):
                    x, y = sorted((top(i), top(j)))
                    leader[y] = x
    expected = Counter((i, len(s), None if i is None else top(i)) for (i, _), s in zip(ROWS, sets))
    assert got(overlap_join.near_duplicates(docs), "doc_id", "n_shingles", "component_id") == expected
    assert got(overlap_join.near_duplicates(docs, hub_rounds=0 + 1), "doc_id", "n_shingles", "component_id") == expected
    assert overlap_join.near_duplicates(empty).count() == 0
    monkeypatch.setattr(overlap_join, "boundary", lambda sizes, percent: 8)  # small sets by their subsets
    assert got(overlap_join.near_duplicates(docs, hub_rounds=0), "doc_id", "n_shingles", "component_id") == expected


def test_small_sets_enumerate_every_link():
    """Light sets: sharing a subset of the needed size is the same as reaching the threshold."""
    for a in range(1, 13):
        for b in range(a, 13):
            for o in range(a + 1):
                assert (100 * o >= 75 * (a + b - o)) == (o >= overlap_join.need(a, b, 75))
            if b not in overlap_join.partners(a, 75):
                assert overlap_join.need(a, b, 75) > a


def test_surrogates(docs, empty):
    out = surrogates.with_surrogates(docs, key=b"k").collect()
    assert len(out) == len(ROWS) and out[0].asDict().keys() >= set(docs.columns)
    by = {r["doc_id"]: r["text"] for r in out}
    for i, t in ROWS:
        if i not in (50, 51):
            assert i is None or by[i] == t
    mail = re.findall(r"\S+@[\w.]+", by[50])
    assert mail[0].lower() == mail[1].lower() and mail[1].isupper() is False and mail[0].lower().rstrip(",") in by[51]
    assert "ann.b" not in by[50].lower() + by[51] and "abc123def" not in by[51] and "10.0.0.7" not in by[51] and " 10." in by[51]
    a, b = re.search(r"\+1 \((\d{3})\) (\d{3})-(\d{4})", by[50]), re.search(r"(\d{3})-(\d{3})-(\d{4})", by[51])
    assert a.groups() == b.groups() and a.group() != "+1 (743) 555-3824"
    card = re.search(r"card ([\d ]{19})", by[50]).group(1)
    assert surrogates.luhn_sum(card.replace(" ", "")) % 10 == 0 and card != "4111 1111 1111 1111"
    assert re.search(r"Mr\. [A-Z][a-z]+ran [A-Z][a-z]+, Mrs [A-Z][a-z]+la [A-Z][a-z]+$", by[50])
    assert surrogates.with_surrogates(empty, key=b"k").count() == 0


def test_surrogates_stay_distinct(spark, monkeypatch):
    """With a drawing that collides at first, entities still get surrogates of their own that are no real entity."""
    rows = [(i, f"ip 10.0.0.{i}") for i in range(1, 9)]
    plain = surrogates.draw
    monkeypatch.setattr(surrogates, "draw", lambda key, kind, c, attempt: "10.0.0.3" if attempt == 0 else "10.9.9.9" if attempt == 1 else plain(key, kind, c, attempt))
    out = surrogates.with_surrogates(spark.createDataFrame(rows, "doc_id long, text string"), key=b"k").collect()
    texts = [r["text"] for r in out]
    assert len(set(texts)) == 8 and not set(texts) & {t for _, t in rows}


def test_masked_secrets_stay(spark):
    rows = [(1, "password: ********"), (2, "api_key=••••••••"), (3, "token = ......"),
            (4, "-----BEGIN PRIVATE KEY-----\n...\n-----END PRIVATE KEY-----"), (5, "password: ٣٤٥٦٧٨٩٠")]
    out = {r["doc_id"]: r for r in surrogates.with_surrogates(spark.createDataFrame(rows, "doc_id long, text string"), key=b"k", attempts=3).collect()}
    for i, t in rows[:4]:
        assert (out[i]["text"], out[i]["n_entities"]) == (t, 0)
    assert out[5]["text"] != rows[4][1] and out[5]["n_entities"] == 1


def test_full_spaces_get_longer_surrogates(spark):
    """More entities than a format has values left: all get surrogates of their own."""
    rows = [(i, f"{c}@x.example.com") for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")]
    rows += [(100, "-@-.com"), (101, "password: ______1")]
    out = surrogates.with_surrogates(spark.createDataFrame(rows, "doc_id long, text string"), key=b"k", attempts=1).collect()
    texts = [r["text"] for r in out]
    assert len(set(texts)) == len(rows) and not set(texts) & {t for _, t in rows} and all(r["n_entities"] == 1 for r in out)
    made = {}
    for kind, c in [("card", "4111111111111111"), ("phone", "7435553824"), ("ssn", "123456789"), ("iban", "AT611904300234573201"), ("ip", "192.168.0.1"),
                    ("ip", "8.8.8.8"), ("email", "a@b.com"), ("secret", "______"), ("key", "-----BEGIN PRIVATE KEY-----\nab\n-----END PRIVATE KEY-----")]:
        made[kind, c] = {surrogates.widen(b"k", kind, c, a, 5) for a in range(300)}
        assert len(made[kind, c]) == 300
    assert all(surrogates.iban_rest(x) == 1 for x in made["iban", "AT611904300234573201"])
    assert surrogates.render("ssn", "123-45-6789", "98765432112345") == "987-65-432112345"


@pytest.mark.parametrize(("text", "found"), [
    ("AT61 1904 3002 3457 3201 BIC", ["AT61 1904 3002 3457 3201"]), ("AT611904300234573201 BIC BKAUATWW", ["AT611904300234573201"]),
    ("ES91 2100 0418 4502 0005 1332 2024", ["ES91 2100 0418 4502 0005 1332"]), ("DE89 3704 0044 0532 0130 00 AND 12", ["DE89 3704 0044 0532 0130 00"]),
    ("REF AB12 CDEF AT61 1904 3002 3457 3201", ["AT61 1904 3002 3457 3201"]), ("AT62 4111 1111 1111 1111 1111", ["4111 1111 1111 1111"]),
    ("NO93 8601 1117 947", ["NO93 8601 1117 947"]), ("NO9386011117947 2024", ["NO9386011117947"]),
    ("AT61 1904 3002 3457 3201 AT61 1904 3002 3457 3201", ["AT61 1904 3002 3457 3201"] * 2),
    ("(743) 555-3824 2024 1234", ["(743) 555-3824 2024"]),
])
def test_numbers_with_words_behind_are_found(text, found):
    assert [text[a:b] for a, b, *_ in surrogates.find_entities(text)] == found


def test_people_are_followed_without_their_titles(spark):
    texts = ["Dr Anna Kern met Ms Anna Kern. Anna Kern, ANNA KERN and Kern; anna kernel. Write to kern@x.com",
             "Mr John Smith, Mr Smith, Mrs Smith, Prof Smith", "Dr. Anna\u0020Kern", "Anna\nKern, says Mrs Anna Kern", "Mr Smith and Smith", "Smith here"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in surrogates.with_surrogates(df, key=b"k").collect()}
    name = re.match(r"Dr ([A-Z][a-z]+la) ([A-Z][a-z]+) met", out[0])
    first, last = name.groups()
    assert re.sub(r"\S+$", "", out[0]) == f"Dr {first} {last} met Ms {first} {last}. {first} {last}, {first.upper()} {last.upper()} and {last}; anna kernel. Write to "
    john, smith = re.match(r"Mr ([A-Z][a-z]+ran) ([A-Z][a-z]+), ", out[1]).groups()
    mrs = re.search(r"Mrs ([A-Z][a-z]+),", out[1]).group(1)
    assert out[1] == f"Mr {john} {smith}, Mr {smith}, Mrs {mrs}, Prof {smith}" and mrs not in (smith, "Smith")
    assert out[2] == f"Dr. {first} {last}" and out[3] == f"{first}\n{last}, says Mrs {first} {last}"
    assert out[4] == f"Mr {mrs} and {mrs}" and out[5] == "Smith here"


@pytest.mark.parametrize(("html", "text"), [
    (None, ""), ("", ""), ("<p>one<p>two", "one\n\ntwo"), ("a <b>b</b>c<br>d", "a bc\nd"),
    ("<ul><li>a<li>b<ol start=3><li>c</ol></ul>", "- a\n- b\n  3. c"),
    ("<table><tr><th>Name<th>N<tr><td>long name<td>1</table>", "Name       N\nlong name  1"),
    ("<table><tr><td rowspan=2>r<td>1<tr><td>2</table>", "r  1\n   2"),
    ("<style>.x{display:none}</style><div class=x>no</div><div hidden>no</div><script>no</script>yes", "yes"),
    ("<details><summary>s</summary>no</details><pre>a\n  b</pre>", "s\n\na\n  b"), ("<div>" * 3000 + "deep", "deep"),
    ("&lt;x&gt; &amp; <!-- c -->y", "<x> & y"), ("< a <", "< a <"),
])
def test_html(html, text):
    assert html_layout.render(html or "") == text


@pytest.mark.parametrize(("css", "shown"), [
    ("@media print { .a, nav {display:none} }", True), ("@media (max-width: 600px) { .a{display:none} }", True),
    ("@media screen and (max-width:40em){.a{display:none}} p{margin:0}", True), ("@media screen{.a{display:none}}", False),
    ("@media only screen and (min-width: 600px) { .a{display:none} }", False), ("@media not print{.a{display:none}}", False),
    ("@media (600px <= width < 900px){.a{display:none}}", True), ("@media print, (min-width:1px){.a{display:none}}", False),
    ("@supports (display:grid){@media print{.a{display:none}} .b{x:y}}", True), ("@media print{@page{margin:0} .a{display:none}}", True),
    (".a{display:none} .a{display:block}", True), (".a{display:block} .a{display:none}", False), (".a{display:none!important} .a{display:block}", False),
    ("#i{display:block} .a{display:none}", True), (".a{display:none} .a.b{display:block}", True), (".a.c{display:none}", True),
    (".a{visibility:hidden} .a{visibility:visible}", True), (".a{visibility:hidden} .a{display:block}", False),
    ("/* } */ .x{content:'{'} .a{color:red;display:none}", False), ("@font-face{src:url(a;b)} .a{display:none", False),
    ("@keyframes k{from{display:none}} div{color:red}", True), (".b .a{display:none}", True), ("div.a{display:none}", False),
])
def test_html_style_rules(css, shown):
    page = f"<style>{css}</style><div class='a b' id=i>text</div>tail"
    assert html_layout.render(page) == ("text\ntail" if shown else "tail")


@pytest.mark.parametrize(("html", "text"), [
    ("let <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math>, so", "let x= 1 2 , so"),
    ("<math><semantics><mrow><mi>y</mi><mphantom><mi>q</mi></mphantom></mrow><annotation encoding='application/x-tex'>\\y</annotation></semantics></math>", "y"),
    ("<math><mtable><mtr><mtd><mn>1</mn></mtd><mtd><mn>2</mn></mtd></mtr><mtr><mtd><mn>3</mn></mtd><mtd><mn>4</mn></mtd></mtr></mtable></math>", "1 2 3 4"),
    ("a<svg><title>t</title><desc>d</desc><defs><text>no</text></defs><metadata>m</metadata>loose<g><path d='M0'/><text x=1>Jan<title>n</title></text>"
     "<text x=2>Fe<tspan>b</tspan></text></g><g style='display:none'><text>no</text></g></svg>b", "a Jan Feb b"),
    ("<svg><text><tspan x=0 dy=1em>one</tspan><tspan x=0 dy=1em>two</tspan></text><foreignObject><span>three</span></foreignObject></svg>", "one two three"),
    ("<svg class=icon><path d='M0 0'/></svg>x", "x"), ("a<xmp>  <b>raw</b> &amp;\n  y</xmp>b", "a\n\n  <b>raw</b> &amp;\n  y\n\nb"),
])
def test_html_formulas_drawings_and_xmp(html, text):
    assert html_layout.render(html) == text


def test_html_inline_style_and_media():
    assert html_layout.render("<style media=print>.a{display:none}</style><p class=a>x") == "x"
    assert html_layout.render("<style>.a{display:none}</style><p class=a style='display:block'>x<p class=a>y") == "x"
    assert html_layout.render("<p style='color:red; display : none'>x<p style='display:none;display:block'>y") == "y"


def test_html_table(spark, empty):
    pages = spark.createDataFrame([(1, "<p>a", "u"), (2, None, None), (None, "<p>b", "x"), (1, "<p>a", "u")], "page_id long, html string, text string")
    out = html_layout.html_text(pages)
    assert got(out, "page_id", "text", "n_lines") == Counter({(1, "a", 1): 2, (2, "", 0): 1, (None, "b", 1): 1})
    assert html_layout.html_text(pages.where("1 = 0")).count() == 0


def test_slices_hold_their_own_text():
    texts = ["Ünïcode TEXT %d  " % i * (i % 7) if i % 5 else None for i in range(200)]
    got = []
    for first, part in text_slices(pa.array(texts), 100):
        assert first == len(got)
        got += list(zip(part.to_pylist(), pc.ascii_lower(part).to_pylist(), pc.ascii_trim_whitespace(part).to_pylist()))
    lower = lambda t: "".join(c.lower() if c.isascii() else c for c in t)
    assert got == [(t, lower(t), t.strip()) for t in (x or "" for x in texts)]


def test_kd_shards_keep_equal_texts_together(spark):
    import random

    rng = random.Random(8)
    texts = ["".join(rng.choice("abcdef ") for _ in range(rng.randint(1, 400))) for _ in range(700)]
    texts += [t for t in texts[:60] for _ in range(rng.randint(1, 12))] + ["the same long text " * 40] * 400  # the last are more than a shard
    rng.shuffle(texts)
    rows = [(i, t, len(t), rng.choice(["en", "de", None]), f"s{i % 7}") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, lang string, source string").repartition(4)
    out = kd_shards.kd_shards(docs, dims=["n_chars", "doc_id", "lang", "source"], shards=8).collect()
    assert len(out) == len(rows)
    where, sizes = defaultdict(set), Counter()
    for r in out:
        where[texts[r["doc_id"]]].add(r["shard"])
        sizes[r["shard"]] += r["size"]
    assert {t[:19] for t, s in where.items() if len(s) > 1} == {"the same long text "}
    assert max(sizes.values()) - min(sizes.values()) < 0.15 * sum(sizes.values()) / 8


def test_kd_shards_of_whole_awkward_table(docs):
    out = kd_shards.kd_shards(docs, dims=["n_chars", "doc_id", "lang", "source"], shards=4).collect()
    assert Counter((r["doc_id"], r["size"]) for r in out) == Counter((i, len((t or "").encode()) + 1) for i, t in ROWS)
    assert {r["shard"] for r in out} <= {0, 1, 2, 3}


def test_token_files_of_extreme_ids(spark):
    docs = spark.createDataFrame([(None, "a b"), (-(1 << 63), "c"), (0, "d e f"), (None, None), ((1 << 63) - 1, "")], "doc_id long, text string")
    out = sorted(token_files.token_files(spark, docs, tokenizer=WORD_BPE, end_id=1).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in out] == [None, None, -(1 << 63), 0, (1 << 63) - 1]


@pytest.mark.parametrize("unit", ["<a ", "<a href=\"x", "<![CDATA[", "<b>", "</i>", "<b></i>", "<!", "<p><b>", "<td>", "<li>x", "<table>", "<!--", "<a b='", "<ul><li>", "<i></p>"])
def test_html_takes_time_in_proportion_to_the_page(unit):
    import time

    def seconds(n):
        begin = time.perf_counter()
        html_layout.build_tree(unit * (n // len(unit)))
        return time.perf_counter() - begin

    seconds(10_000)
    assert seconds(1_000_000) < 20  # a megabyte; quadratic reading takes hours


@pytest.mark.parametrize(("html", "text"), [
    ("<p>a<a href=\"x>b</a> c", "a"), ("x <b", "x"), ("a <p title=it's>b", "a\n\nb"), ("<a title = 'x>y'>z</a>", "z"), ("<a title=\"x>y\" b>z", "z"),
    ("<![CDATA[ a > b", "b"), ("<svg><text><![CDATA[a]]>b</text></svg>", "b"), ("<noscript>shown</noscript>", "shown"),
    ("<object>instead</object><object data=x.png>no</object>", "instead"),
    ("<ol reversed><li>a<li>b</ol>", "2. a\n1. b"), ("<ol type=a><li>x<li value=28>y<li>z</ol>", "a. x\nab. y\nac. z"), ("<ol type=I start=1994><li>x</ol>", "MCMXCIV. x"),
    ("<table>before<tr><td>c</table>", "before\n\nc"), ("<table><tr>in<td>c</tr> <tr><td>d</table>", "in\n\nc\nd"),
    ("<b>" * 700 + "deep</b> tail", "deep tail"),
])
def test_html_ends_lists_and_stray_text(html, text):
    assert html_layout.render(html) == text
