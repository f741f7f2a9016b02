"""Quality, mixing, sharding, WARC, url rules."""

import re
import zlib

import pytest

from threadloom.llm import mixing, quality, sharding, urlfilter, warc

from . import brute


def test_measures_equal_brute_force(docs):
    found = quality.measure(docs).collect()
    rows = docs.select("doc_id", "text").collect()
    assert brute.by_id((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found) == brute.by_id(
        (r.doc_id, *brute.measures(r.text)) for r in rows)


def test_bounds_are_exact():
    for k, n, level in ((0, 100, 0.05), (3, 50, 0.01), (20, 4000, 0.001)):
        bound = quality.upper_bound(k, n, level)
        assert abs(quality.binomial_tail(k, n, bound) - level) < 1e-9
    assert quality.upper_bound(0, 100, 0.05) == pytest.approx(1 - 0.05 ** 0.01)
    assert quality.upper_bound(5, 5, 0.1) == quality.upper_bound(0, 0, 0.1) == 1.0


def test_cutoffs_reject_few_good_rows(spark, no_docs):
    good = [(i, "word " * 3 + " ".join(f"w{i}x{j}" for j in range(60)), "en", 1) for i in range(2500)]
    bad = [(5000 + i, " ".join(f"w{i}&{j}" for j in range(60)), "en", 0) for i in range(200)]
    rare = [(9000 + i, " ".join(f"q{i}&{j}" for j in range(60)), None, 1) for i in range(5)]
    frame = spark.createDataFrame(good + bad + rare, "doc_id long, text string, lang string, good int")
    found = {r.doc_id: r for r in quality.judge(frame, frame.select("doc_id", "good")).collect()}
    assert len(found) == 2705 and all(found[i].kept for i, *_ in good + rare)
    assert not any(found[i].kept for i, *_ in bad) and "symbols_per_word" in found[5000].broken_rules
    assert quality.judge(no_docs, frame.select("doc_id", "good")).count() == 0


def test_edge_rows_without_labels(docs):
    labels = docs.selectExpr("doc_id", "cast(null as int) as good")
    found = quality.judge(docs, labels).collect()
    rows = docs.select("doc_id", "text").collect()
    failed = brute.by_id((r.doc_id, (m := brute.measures(r.text))[0] < 50 or 100 * m[4] > 50 * m[0]) for r in rows)
    assert brute.by_id((r.doc_id, r.base_failed) for r in found) == failed
    assert all(r.kept != r.base_failed for r in found)


def test_mix_reaches_its_targets(docs, no_docs):
    rows = docs.select("doc_id", "text", "source").collect()
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + len(brute.WORD.findall(r.text or ""))
    expected = brute.targets(sizes, 1.5, (3, 1, 2))
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    taken, largest = {}, {}
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(expected[r.source]) and 0 <= r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), r.size)
    assert all(abs(taken[s] - expected[s]) <= largest[s] / 2 + 1e-6 for s in sizes)
    again = mixing.mix(docs.repartition(7)).collect()
    assert brute.by_id((r.doc_id, r.size, r.taken) for r in found) == brute.by_id((r.doc_id, r.size, r.taken) for r in again)
    repeated = mixing.mixed(docs)
    assert repeated.columns == docs.columns
    words = {}
    for r in repeated.select("source", "text").collect():
        words[r.source] = words.get(r.source, 0) + len(brute.WORD.findall(r.text or ""))
    assert {s: n for s, n in words.items() if n} == {s: n for s, n in taken.items() if n}
    assert mixing.mix(no_docs).count() == mixing.mixed(no_docs).count() == 0


def test_mix_prefers_heavier_documents(spark):
    rows = [(i, "w " * 20, "a", 1.0 + 3 * (i % 2)) for i in range(400)] + [(1000 + i, "w " * 20, "b", 1.0) for i in range(3000)] + [(9999, "w", "a", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, value double")
    found = mixing.mix(frame, share=0.12, weights=(1, 1), weight="value").where("source = 'a'").collect()
    heavy = sum(r.taken for r in found if r.doc_id % 2)
    light = sum(r.taken for r in found if not r.doc_id % 2)
    assert heavy > 1.5 * light and abs(heavy + light - found[0].target) <= 20


def test_shards_are_even_and_gapless(docs, no_docs):
    rows = docs.select("doc_id", "text").collect()
    found = sharding.shard(docs, 4, slots=64).collect()
    assert brute.by_id((r.doc_id, r.size, r.text_crc32) for r in found) == brute.by_id(
        (r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in rows)
    for s in range(4):
        own = sorted(r.slot for r in found if r.shard == s)
        assert own == list(range(len(own)))
    assert all(r.law == "bytes" and r.grown_shard is None for r in found)
    assert sharding.shard(no_docs, 4).count() == 0


def test_shard_bytes_are_near_equal_and_edits_move_little(spark, tmp_path):
    frame = spark.range(3000).selectExpr("id as doc_id", "repeat('x', cast(1 + pow(id % 17, 2) as int)) as text")
    found = sharding.shard(frame, 8, path=str(tmp_path / "map"))
    loads = [r.n for r in found.groupBy("shard").agg({"size": "sum"}).toDF("shard", "n").collect()]
    assert len(loads) == 8 and max(loads) - min(loads) <= 0.01 * sum(loads) / 8
    first, second = (dict(sharding.load_version(spark, str(tmp_path / "map"), v).collect()) for v in (1, 2))
    assert sorted(second) == list(range(sharding.SLOTS)) and sum(first[s] != second[s] for s in first) < sharding.SLOTS / 4
    grown = dict(sharding.edit_map(sharding.load_version(spark, str(tmp_path / "map"), 2), spark.read.parquet(str(tmp_path / "map/loads")), 9, [8]).collect())
    assert {grown[s] for s in grown if grown[s] != second[s]} == {8}


def page_rows():
    rows = [(i, f"http://h{i}.example.com/p", f"<p>{i % 7}</p>" * (i % 5)) for i in range(60)]
    return rows + [(None, None, "<p>1</p>"), (None, "http://x/", None), (70, "http://a\r\nb/", "é" * 50_000), (59, "http://again/", rows[59][2]), (71, "u", None)]


@pytest.mark.parametrize("least", [0, 9])
def test_warc_round_trip(spark, monkeypatch, least):
    monkeypatch.setattr(warc, "FILE_BYTES", 2000)
    monkeypatch.setattr(warc, "REQUEST_BYTES", 1500)
    rows = page_rows()
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as last", "2 as mark", "3 as offset")
    found = warc.round_trip(frame, least).collect()
    expected = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [k for k, _, other in rows if (other or "").encode() == data and k is not None]
        again = len(data) >= least and bool(same) and sum((o or "").encode() == data for *_, o in rows) > 1 and i != max(same)
        expected.append((i, len(data), warc.digest(data), "revisit" if again else "response", max(same) if again else None, None if again else data))
    assert brute.by_id((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload) if r.payload is not None else None) for r in found) == brute.by_id(expected)
    assert warc.round_trip(frame.where("false")).count() == 0


def test_warc_reads_selected_records(spark, tmp_path):
    frame = spark.createDataFrame(page_rows(), "page_id long, url string, html string")
    index = warc.write(frame, str(tmp_path / "warc"))
    assert set(index.columns) >= {"file", "offset", "length", "url", "payload_digest"}
    assert {r.page_id for r in warc.read(index.where("page_id % 10 = 3"), str(tmp_path / "warc")).collect()} == {3, 13, 23, 33, 43, 53}


def test_ranges_are_coalesced():
    rows = [("a", 0, 10), ("a", 10, 5), ("a", 15 + warc.GAP_BYTES, 5), ("a", 10 ** 9, 5), ("b", 0, 1)]
    assert [(n, b, e, len(r)) for n, b, e, r in warc.coalesce(iter(rows))] == [("a", 0, 20 + warc.GAP_BYTES, 3), ("a", 10 ** 9, 10 ** 9 + 5, 1), ("b", 0, 1, 1)]


def test_url_rules_equal_brute_force(spark):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("b.net", "", "block"), ("com", "/", "allow")]
    urls = [None, "", "x", "http://", "://com/", "HTTP://WWW.Example.COM/en/a?q", "http://notexample.com/en/", "http://a.example.com/en", "http://example.com/en/x#y://net/es/",
            "s://b.net", "s://a.b.net/es/1", "s://xb.net/es/1", "s://É.net/es/ÉA\n?x", "s://com?x/", "s://com"] + [f"http://h{i % 40}.example.{'com' if i % 3 else 'net'}/{['en', 'es', 'x'][i % 3]}/{i}" for i in range(400)]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "1 as host", "2 as keys", "3 as at", "4 as blocks")

    def parts(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest).group()
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host):]).group()

    def judge(host, path):
        fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fit)[1:] if fit else (None, "allow")

    expected = {i: (*(hp := parts(u)), *judge(*hp)) for i, u in enumerate(urls)}
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.filter_urls(frame, table).collect()}
    assert found == expected
    assert {r.rule for r in urlfilter.filter_urls(frame, table.where("false")).collect()} == {None}
    assert urlfilter.filter_urls(frame.where("false"), table).count() == 0


@pytest.mark.parametrize("parts", [1, 3])
def test_cascade_is_exact_over_the_universe(spark, monkeypatch, parts):
    monkeypatch.setattr(urlfilter, "_parts", lambda n: parts)
    rules = spark.range(0, 4000, 3).selectExpr("concat('h', id, '.com') as host", "'/' as path", "if(id % 2 = 0, 'block', 'allow') as verdict")
    pages = spark.range(4000).selectExpr("id as page_id", "concat('http://h', id, '.com/x') as url")
    for r in urlfilter.filter_urls(pages, rules).collect():
        assert (r.rule, r.verdict) == ((f"h{r.page_id}.com/", "block" if r.page_id % 2 == 0 else "allow") if r.page_id % 3 == 0 else (None, "allow"))
