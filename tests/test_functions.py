"""Functions and operators on small tables of their own."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quillsift.config import Prompt, UrlRules, load, merged
from quillsift.functions import coerce, content
from quillsift.functions import text as T
from quillsift.functions import urls as U
from quillsift.operators import candidates, evidence, incremental, match, rules, screening, segments
from quillsift.sources import files


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def texts(spark, values, f):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.select("i", f(F.col("v")).alias("r")).orderBy("i").select("r").collect()]


def test_text(spark):
    assert texts(spark, ["  “Haus”  am\tSee ", None, ""], T.sanitize) == ["Haus am See", "", ""]
    assert texts(spark, ["Verein_X & Co.", "Ä-Ö"], T.name_key) == ["verein x co", "ä ö"]
    assert texts(spark, ["üTöss", "in Töss.", "TÖSS"], lambda c: T.contains_token(F.lower(c), "töss")) == [False, True, True]
    assert texts(spark, ["Größe (alt) [x]"], T.name_variants) == [["groesse alt x", "groesse"]]
    assert texts(spark, ["a b  c", ""], T.count_words) == [3, 0]
    assert texts(spark, ["Hund hund HUNDE"], lambda c: T.keyword_count(c, ["hund"])) == [2]
    assert texts(spark, ["Hund hund HUNDE"], lambda c: T.keyword_count(c, ["hund"], whole_words=False)) == [3]
    assert texts(spark, ["1234567", "x"], T.thousands) == ["1'234'567", "-"]
    assert texts(spark, ["2024-03-01T10:05:00Z", "soon"], T.shown_time) == ["01.03.2024 10:05", "soon"]
    assert texts(spark, [" Über uns! "], T.slug) == ["über-uns"] and texts(spark, ["!"], T.slug) == ["unnamed"]


def test_byte_size(spark):
    sizes = ["0", "1023", "1024", "1280", "1048575", "1048576", str(3 << 30), str(1 << 50), str(1 << 63)]
    shown = ["0 B", "1023 B", "1.0 KB", "1.2 KB", "1024.0 KB", "1.0 MB", "3.0 GB", "1024.0 TB", "8388608.0 TB"]
    assert texts(spark, sizes, lambda c: T.byte_size(c.cast("double"))) == shown
    assert texts(spark, sizes[:-1], lambda c: T.byte_size(c.cast("bigint"))) == shown[:-1]
    assert texts(spark, sizes[4:7], lambda c: T.byte_size(c.cast("bigint"), largest="KB")) == ["1024.0 KB", "1024.0 KB", "3145728.0 KB"]


def test_coerce(spark):
    df = spark.createDataFrame([("", "12.0"), ("true", "-3"), ("NO", "abc"), ("invalid", None)], "b string, n string")
    out = coerce.ensure(coerce.ensure(coerce.ensure(df, "boolean", {"b": None}), "whole", {"n": 0}), "text", {"note": ""})
    assert [tuple(r) for r in out.collect()] == [(None, 12, ""), (True, -3, ""), (False, 0, ""), (None, 0, "")]
    assert coerce.first_present(df, ["x", "n"]) == "n"
    got = texts(spark, ["2024-01-02T03:04:05Z", "2024-01-02 junk", "?"], coerce.lastmod)
    assert [x and x.isoformat() for x in got] == ["2024-01-02T03:04:05", "2024-01-02T00:00:00", None]


def test_normal_urls(spark):
    urls = ["HTTP://Ex.org:80?q#f", "https://a.b/c/", "ftp://x/", "nothing", None, "https://"]
    assert texts(spark, urls, U.normalize) == ["http://Ex.org:80/", "https://a.b/c/", "", "", "", ""]
    assert texts(spark, ["http://www.A.org:81/x", "https://a.org/x"], U.identity) == ["www.a.org/x", "a.org/x"]
    assert texts(spark, ["a.b.co.uk", "x.example.org", "org"], U.registrable) == ["b.co.uk", "example.org", "org"]
    assert texts(spark, ["/a%20b", "/a+b", "/%zz"], U.decoded) == ["/a b", "/a b", "/%zz"]


SCOPES = [
    ("https://x.org", "host", "/", "root_seed"),
    ("https://x.org/de/", "host", "/", "scaffold_promoted_to_host_root:language_root_seed"),
    ("https://x.org/leaf", "host", "/", "single_leaf_promoted_to_host_root"),
    ("https://x.org/about", "host", "/", "promoted_to_host_root:about"),
    ("https://x.org/club/kontakt", "path_prefix", "/club/", "promoted_before_boundary:kontakt"),
    ("https://x.org/about/club", "path_prefix", "/about/club/", "kept_path_prefix"),
    ("https://x.org/club/page.html", "path_prefix", "/club/", "file_leaf_promoted_to_parent"),
    ("https://x.org/cms/page.html", "host", "/", "scaffold_promoted_to_host_root:file_leaf_promoted_to_parent"),
    ("mailto:x", "", "", "invalid_or_unsupported_url"),
]


def test_scope(spark):
    rows = U.with_scope(spark.createDataFrame([(u,) for u, *_ in SCOPES], "url string"), "url", UrlRules()).collect()
    assert {(r.url, r.scope_mode, r.path_prefix, r.scope_reason) for r in rows} == set(SCOPES)


def test_exclusions_and_score(spark):
    reasons = texts(spark, ["https://x.org/a.pdf", "https://x.org/www.y.org/", "https://x.org/my-login", "https://x.org/wp-admin", "https://x.org/api/v1", "https://x.org/fine"], lambda c: U.technical_reason(c, UrlRules()))
    assert reasons == ["non_html_extension:.pdf", "embedded_hostname:www.y.org", "exclude_tokens:login", "exclude_regex:wp-admin", "technical_root:api", ""]
    urls = [("https://x.org/seed", None, ""), ("https://x.org/", None, ""), ("https://x.org/de", None, ""), ("https://x.org/about/team/2020/x/y/z", 1.0, "2020-01-01")]
    df = spark.createDataFrame(urls, "url string, p double, m string")
    rows = U.with_score(df, "url", F.lit("https://x.org/seed"), F.col("p"), F.col("m"), F.lit("2024-01-01").cast("timestamp"), UrlRules()).collect()
    score = {r.url: r for r in rows}.get
    assert score("https://x.org/seed").score == 20 and score("https://x.org/").score == 18 and score("https://x.org/de").score == 10
    got = score("https://x.org/about/team/2020/x/y/z")
    assert got.score == 12 + 6 - 5 - 14 + 3 - 2 and got.reasons[:2] == ["favor_tokens:about|team", "favor_regex"] and got.reasons[-1] == "lastmod_stale"


def test_capped_rank_by_brute_force(spark):
    rng = random.Random(3)
    rows = [(g, f"s{rng.randrange(4)}", rng.randrange(5), rng.randrange(3), f"https://x/{g}/{i}") for g in range(12) for i in range(rng.randrange(1, 25))]
    got = candidates.capped(spark.createDataFrame(rows, "e int, section string, score int, depth int, url string"), "e", 2, 9)
    want = {}
    for g in range(12):
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[3], len(r[4]) - len("https://x"), r[4]))
        first, over, per = [], [], {}
        for r in own:
            per[r[1]] = per.get(r[1], 0) + 1
            (first if per[r[1]] <= 2 else over).append(r)
        want |= {r[4]: (k, "keep" if r in first else "keep_after_section_cap") for k, r in enumerate((first + over)[:9], 1)}
    assert {r.url: (r["rank"], r.decision) for r in got.collect()} == want


def test_segments(spark):
    shared = "A long passage that three pages share"
    rows = [("o", f"p{i}", i, f"{shared}\n\nown words of page number {i}") for i in range(3)]
    df = spark.createDataFrame(rows, "org string, page string, ord int, content string")
    segs = segments.split(df, "org", "page", "ord", "content")
    totals = df.groupBy("org").agg(F.count("*").alias("page_total"))
    out = segments.pages(segments.flagged(segs, segments.duplicates(segs, "org", totals, 20, 0.6), "org"), "org").orderBy("page").collect()
    assert [r.segments_removed for r in out] == [0, 1, 1] and shared in out[0].content and shared not in out[1].content
    gone = segments.pages(segments.flagged(segs, segments.duplicates(segs, "org", totals, 20, 0.6, retain=False), "org"), "org").collect()
    assert all(r.segments_removed == 1 for r in gone)
    assert one(spark, segments.threshold(F.lit(100), 0.07).alias("t")).t == 8  # in doubles


def test_budget_by_brute_force(spark):
    rng = random.Random(5)
    rows = [(g, i, " ".join("ab" * rng.randrange(1, 6) for _ in range(rng.randrange(0, 12)))) for g in range(20) for i in range(8)]
    got = {}
    for r in evidence.snippets(spark.createDataFrame(rows, "g int, i int, t string"), "g", "i", "t", keyword_order=False, chars=40, most=6, total=90).collect():
        got.setdefault(r.g, []).append((r["rank"], r.snippet))
    for g in range(20):
        want, used = [], 0
        for _, _, t in (r for r in rows if r[0] == g):
            t = t[:40].strip()
            if len(want) >= 6 or used >= 90:
                break
            if not t:
                continue
            if len(t) > 90 - used:
                t = t[: 90 - used].strip()
                if not t:
                    break
            want.append(t)
            used += len(t)
        assert [s for _, s in sorted(got.get(g, []))] == want


def test_partition(spark):
    rows = [("8400 Aa", None), ("Bb Aa", None), ("Bb", "include"), ("Aa", "exclude"), (" ", None), ("Aaa", None)]
    df = match.exact(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, place string, decision string"), "place", ["Aa", "Bb"])
    out = match.partition(df, ["Aa"]).orderBy("i").collect()
    assert [(r.matched_term, r.bucket) for r in out] == [("Aa", "matched"), ("Aa", "matched"), ("Bb", "matched"), ("Aa", "excluded"), (None, "excluded"), (None, "excluded")]


def test_similarity():
    assert match.similarity("winterthur", "winterthur") == 100 and match.lcs("abcde", "ace") == 3
    assert match.ratio("abcd", "abxd") == 75 and match.partial_ratio("stadt winterthur", "winterthur") == 100
    assert match.similarity("b a", "a b") == 100


def test_rules(spark):
    values = {"s": (F.lit("Ab"), "string"), "n": (F.lit(5.0), "number"), "l": (F.array(F.lit("x"), F.lit("y")), "strings"), "none": (F.lit(None).cast("string"), "string")}
    cases = [
        ("s", "eq", "Ab", True), ("s", "eq", "x", False), ("none", "eq", None, True), ("none", "neq", "x", True), ("s", "neq", "Ab", False), ("s", "in", ["Ab"], True), ("s", "in", "Ab", False),
        ("none", "not_in", ["x"], True), ("s", "not_in", ["Ab"], False), ("n", "gte", 5, True), ("n", "lte", 4, False), ("s", "gte", 1, False), ("s", "exists", None, True), ("none", "exists", None, False),
        ("s", "contains", "b", True), ("l", "contains", "x", True), ("l", "intersects", [" X"], True), ("l", "intersects", ["z"], False), ("s", "intersects", ["z"], False), ("l", "len_gte", 2, True), ("l", "len_eq", 3, False), ("s", "what", 1, False),
    ]
    got = one(spark, *[rules.matches(rules.Rule(f, op, v), *values[f]).alias(f"c{i}") for i, (f, op, v, _) in enumerate(cases)])
    assert list(got) == [c[3] for c in cases]


def test_objects(spark):
    fields = [rules.Field("evidence", "objects", item_keys=("quote", "snippet_id"), items=2)]
    answer = lambda t: one(spark, *[c.alias(k) for k, c in rules.normalize(rules.extract_object(F.lit(t)), fields, snippet_ids=F.array(F.lit("s1"))).items()])
    good = answer('x {"evidence": [{"snippet_id": "s1", "quote": " q "}, {"snippet_id": "s9", "quote": "q"}, {"snippet_id": "s1", "quote": ""}]} y')
    assert good.error is None and [tuple(e) for e in good.evidence] == [("q", "s1")]
    assert answer('{"evidence": [{"quote": "q"}]}').error == "invalid_item_keys:evidence" and answer("[1]").error == "no_object"


def test_state(spark):
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), spark.createDataFrame([(2, "c", 1), (3, "d", 1)], "id int, v string, w int")
    assert sorted(tuple(r) for r in incremental.append_new(old, new, "id").collect()) == [(1, "a", None), (2, "b", None), (3, "d", 1)]
    assert sorted(tuple(r) for r in incremental.upsert(old, new, "id").collect()) == [(1, "a", None), (2, "c", 1), (3, "d", 1)]
    assert sorted(r.v for r in incremental.apply_decisions(old, spark.createDataFrame([(1, "z")], "id int, v string"), "id", ["v"]).collect()) == ["b", "z"]
    a, b = (one(spark, F.lit("x").alias("p"), F.lit(v).alias("q")) for v in ("1", "2"))
    sig = lambda r: spark.createDataFrame([r]).select(T.signature("q", "p").alias("s")).first().s
    assert sig(a) == sig(a) != sig(b)


def test_quality_and_markers(spark):
    long = "# Title\n\n" + "\n\n".join(f"Sentence number {i} is here. " * 14 for i in range(6))
    score = lambda t: content.with_quality(spark.createDataFrame([(t,)], "t string"), "t", F.lit("t"), F.lit("")).first().score
    assert score(long) == 35 + 10 + 10 + 5 + 5 and score(" ") == 0 and score(None) == 0
    assert score("a line \n" * 200) == 25 + 5 - 10  # every line but the first is repeated
    assert score("[a long name of a link that goes on](x) " * 20 + "w") == 15 + 5 - 20
    assert score("home menu Kontakt. " * 60) == 15 + 5 + 5 - 10  # words of page furniture
    assert one(spark, content.best_extractor({"a": F.lit(30), "b": F.lit(30)}).alias("x")).x == "a"
    assert one(spark, content.best_extractor({"a": F.lit(90), "b": F.lit(35)}, preferred="b").alias("x")).x == "b"
    assert not one(spark, content.rendered_wins(F.lit(30), F.lit(30)).alias("x")).x


def test_sources(spark, tmp_path):
    (tmp_path / "t.csv").write_text('﻿_org_id,_text\n1,"a\nb"\n2,\n', encoding="utf-8")
    df = files.read_csv(spark, str(tmp_path / "t.csv"))
    assert df.columns == ["_org_id", "_text"] and [tuple(r) for r in df.collect()] == [("1", "a\nb"), ("2", "")]
    assert files.read_or_empty(spark, str(tmp_path / "none.csv"), ["x"]).columns == ["x"]
    files.write_csv(df, str(tmp_path / "out"))
    assert sorted(tuple(r) for r in files.read_csv(spark, str(tmp_path / "out")).collect()) == [("1", "a\nb"), ("2", "")]
    pages = tmp_path / "orgs/o1"
    pages.mkdir(parents=True)
    (pages / "001-a.md").write_text("text\nmore")
    assert [tuple(r) for r in files.read_pages(spark, str(tmp_path / "orgs/*")).collect()] == [("o1", "001-a.md", 1, "text\nmore")]
    words = [(1, 10.0, 5.0, "Long"), (1, 10.0, 20.0, "name"), (1, 20.0, 5.0, "goes on"), (1, 20.0, 460.0, "Here"), (1, 20.0, 540.0, "a"), (1, 30.0, 5.0, "B"), (1, 30.0, 540.0, "b")]
    got = files.table_lines(spark.createDataFrame(words, "page int, top double, x0 double, text string")).orderBy("line").collect()
    assert [(r.name, r.place, r.category) for r in got] == [("Long name goes on", "Here", "a"), ("B", "", "b")]
    got = one(spark, files.links(F.lit('<a href="/x">x</a> <a class=q href="y.html"> <a href="mailto:q"> <a href="#t">'), F.lit("https://h.org/d/p.html?q")).alias("l")).l
    assert got == ["https://h.org/x", "https://h.org/d/y.html"]


def test_stream_keeps_latest(spark, tmp_path):
    from quillsift.sources import folders
    from quillsift.streaming.latest import keep_latest, listed, read_latest, versions

    schema, out = "k int, t int, v string", str(tmp_path / "out")
    assert read_latest(spark, out, schema).count() == 0

    def batch(rows, checkpoint="cp"):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
        keep_latest(stream, out, str(tmp_path / checkpoint), ["k"], ["t"], parts=4).awaitTermination()
        return sorted(r.v for r in read_latest(spark, out, schema).collect())

    assert batch([(k, 1, f"a{k}") for k in range(20)]) == sorted(f"a{k}" for k in range(20))
    assert len(listed(spark, out)) == 4
    got = batch([(1, 2, "c"), (30, 1, "d")])
    assert got == sorted([f"a{k}" for k in range(20) if k != 1] + ["c", "d"])
    assert sum(v == 1 for v in listed(spark, out).values()) <= 2  # other parts stay as they were
    got = batch([(1, 1, "late"), (2, 3, "e")])
    assert "late" not in got and "e" in got and "a2" not in got
    assert len(versions(spark, out)) == 2
    # A new checkpoint reads all batches again and forgets nothing.
    assert batch([(40, 1, "f")], "other") == sorted([*got, "f"])
    used = {f"version={v}" for v in listed(spark, out).values()}
    assert used <= set(folders.names(spark, f"{out}/rows")) and len(folders.names(spark, f"{out}/rows")) <= 5


def test_stale_stream(spark, tmp_path):
    from quillsift.streaming.latest import stale_stream

    spark.createDataFrame([(1, "a"), (2, "b"), (3, ""), (4, "d")], "k int, s string").write.json(str(tmp_path / "in"))
    live = spark.createDataFrame([(1, "a "), (2, "x"), (3, "c")], "k int, s string")
    out = stale_stream(spark.readStream.schema("k int, s string").json(str(tmp_path / "in")), live, "k", "s")
    out.writeStream.format("memory").queryName("stale").trigger(availableNow=True).start().awaitTermination()
    assert sorted((r.k, r.stale_reason) for r in spark.table("stale").collect()) == [(2, "signature_mismatch"), (3, "blank_signature"), (4, "missing_live_row")]


def test_folders(spark, tmp_path):
    from quillsift.sources import folders

    root = str(tmp_path / "data")
    for part in ("raw", "parsed", "orgs"):
        (tmp_path / "data" / part).mkdir(parents=True)
        (tmp_path / "data" / part / "x.csv").write_text("abc")
    assert folders.sizes(spark, root) == {"orgs": 3, "parsed": 3, "raw": 3}
    folders.export(spark, f"{root}/raw", f"{root}/copy")
    folders.export(spark, f"{root}/raw", f"{root}/copy")
    assert folders.names(spark, f"{root}/copy") == ["x.csv"] and folders.names(spark, f"{root}/none") == []
    parts = ("raw", "parsed", "orgs")
    assert folders.reset(spark, root, parts, but={"raw"}) == {"parsed": 1, "orgs": 1}
    assert folders.sizes(spark, root) == {"copy": 3, "orgs": 0, "parsed": 0, "raw": 3}
    assert folders.reset(spark, root, parts, only={"raw"}) == {"raw": 1}
    with pytest.raises(ValueError):
        folders.reset(spark, root, parts, only={"nonsense"})


def test_artefact_files(spark, tmp_path):
    from quillsift.sources import folders

    for name, body in (("o1/q01", '{"a": 1}'), ("o2/q01", "{broken"), ("o3/q02", "[1]"), ("o4/q02", "")):
        (tmp_path / "orgs" / name).mkdir(parents=True)
        (tmp_path / "orgs" / name / "ask.json").write_text(body)
    rows = folders.read_artefacts(spark, str(tmp_path / "orgs/*/*"), "a int").orderBy("entity").collect()
    assert [(r.entity, r.question, r.name, r.artefact, r["values"].a) for r in rows][:3] == [("o1", "q01", "ask.json", '{"a": 1}', 1), ("o2", "q01", "ask.json", "{}", None), ("o3", "q02", "ask.json", "{}", None)]
    schema, path = "question string, n int", str(tmp_path / "conclusions")
    assert folders.read_conclusions(spark, path, schema).count() == 0
    folders.write_conclusions(spark.createDataFrame([("q02", 2), ("q01", 1)], schema), path)
    (tmp_path / "conclusions" / "part-bad.json").write_text("{broken\n")
    assert sorted(tuple(r) for r in folders.read_conclusions(spark, path, schema).collect()) == [("q01", 1), ("q02", 2)]
    df = spark.createDataFrame([(1, ""), (2, "odd")], "i int, _parse_warning string")
    assert folders.write_parsed(df, str(tmp_path / "parsed"))
    assert spark.read.option("header", True).csv(str(tmp_path / "parsed/warnings")).count() == 1
    assert not folders.write_parsed(df.filter("i = 1"), str(tmp_path / "parsed")) and not (tmp_path / "parsed/warnings").exists()


def test_config(tmp_path):
    (tmp_path / "r.toml").write_text('favor = ["x"]\ntechnical_pairs = [["a", "b"]]')
    rules_ = load(UrlRules(), tmp_path / "r.toml", tmp_path / "none.toml")
    assert rules_.favor == ("x",) and rules_.technical_pairs == (("a", "b"),) and rules_.languages == UrlRules().languages
    with pytest.raises(ValueError):
        merged(UrlRules(), {"nonsense": 1})
    with pytest.raises(ValueError):
        Prompt("Hi {a}", ("b",))
    assert Prompt("Hi {a}", ("a",)).render(a="x") == "Hi x"


def test_conclusions_keep_notes(spark):
    df = spark.createDataFrame([(1, "", "seen", "auto_excluded", "", "", ""), (2, "", "", "needs_review", "excluded", " other ", "n"), (3, "X", "", "auto_excluded", "", "", "")], "i int, reason string, note string, auto string, review string, code string, rn string")
    out = screening.conclude(df, "q", "auto", "review", "reason", "note", F.lit(True), "code", "rn").orderBy("i").collect()
    assert [(r.reason, r.note) for r in out] == [("IRRELEVANT_PURPOSE", "seen | classify:q:auto_excluded"), ("OTHER", "classify:q:review_excluded:OTHER | n"), ("X", "")]


def test_question_files(tmp_path):
    from quillsift.plans.details import FILE
    from quillsift.questions import load_prompts, load_questions, read_question

    q = read_question(FILE, "q09")
    assert (q.id, q.order, q.strict, q.attempts, [f.kind for f in q.fields]) == ("q09_kind", 9, True, 2, ["string", "number"])
    assert [(p.priority, p.action, p.any_of, p.reason) for p in q.policies] == [(20, "auto_excluded", False, "Matched policy rule low."), (10, "auto_accepted", True, "People did something.")]
    assert q.prompt.render(text="x") == "Text: x" and q.source.limits()["most"] == 18
    wrong = [(b"auto_exclude", b"drop"), (b'mode = "any"', b'mode = "some"'), (b'conditions = [{ field = "value", op = "lte", value = 20 }]', b"conditions = []"), (b'required_keys = ["kind", "value"]', b'required_keys = ["none"]'), (b'{ key = "value"', b'{ key = "kind"'), (b'kind = "number"', b'kind = "what"'), (b'text = "the text"', b'other = "x"')]
    for old, new in wrong:
        assert old in FILE
        with pytest.raises(ValueError):
            read_question(FILE.replace(old, new), "q09")
    with pytest.raises(ValueError):
        load_questions(tmp_path)
    (tmp_path / "classify.q09.toml").write_bytes(FILE)
    (tmp_path / "classify.q01.toml").write_bytes(FILE.replace(b"q09_kind", b"q01").replace(b"order = 9", b"order = 1"))
    assert [q.id for q in load_questions(tmp_path)] == ["q01", "q09_kind"]
    (tmp_path / "classify.q02.toml").write_bytes(FILE)
    with pytest.raises(ValueError):
        load_questions(tmp_path)
    folder = tmp_path / "prompts"
    folder.mkdir()
    (folder / "a.toml").write_text('[prompt]\nid = "a"\ntemplate = "Hi {x}"\n[prompt.placeholders]\nx = "name"\n[prompt.response]\nrequired_keys = ["url"]')
    assert load_prompts(folder)["a"].prompt.render(x="y") == "Hi y" and load_prompts(folder)["a"].required_keys == ("url",)
    (folder / "b.toml").write_text('[prompt]\nid = "b"\ntemplate = "Hi {x}"\n[prompt.placeholders]\nz = "name"')
    with pytest.raises(ValueError):
        load_prompts(folder)


def test_access_errors(spark):
    cases = [
        ("OpenAI", 401, "", "", "", "unauthorized_or_forbidden"), ("openai", 429, "Rate limit reached, requests per minute", "", "", None), ("openai", 429, "You exceeded your current quota", "", "", "quota_exhausted"),
        ("openai", 429, "?", "invalid_api_key", "", "quota_exhausted"), ("openai", 429, "?", "", "", "unknown_429"), ("openai", None, "?", "insufficient_quota", "", "quota_exhausted"), ("openai", None, "?", "account_deactivated", "", "unauthorized_or_forbidden"),
        ("openai", None, "?", "", "AuthenticationError", "unauthorized_or_forbidden"), ("openai", None, "insufficient_quota", "", "RateLimitError", "quota_exhausted"), ("openai", None, "?", "", "RateLimitError", None), ("openai", 500, "?", "", "", None),
        ("brave", 429, "?", "", "", "unknown_429"), ("other", 429, "?", "", "", None),
    ]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, p string, s int, b string, c string, k string, want string")
    got = df.select("want", screening.access_error(F.col("p"), F.col("s"), F.col("b"), F.col("c"), F.lit(""), F.col("k")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, "matched"), (2, "review"), (3, "matched")], "i int, bucket string")
    files.write_json(df, str(tmp_path / "j"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "j")).collect())[0] == '{"i":1,"bucket":"matched"}'
    files.write_buckets(df, str(tmp_path / "b"))
    files.write_buckets(df.filter("i = 2").withColumn("i", F.lit(9)), str(tmp_path / "b"))
    assert sorted((r.i, r.bucket) for r in spark.read.parquet(str(tmp_path / "b")).collect()) == [(1, "matched"), (3, "matched"), (9, "review")]


def test_counts_by_window(spark, tmp_path):
    from quillsift.streaming.latest import counts_by_window

    schema = "t timestamp, k string"
    spark.sql("select timestamp'2024-01-01 10:10:00' t, 'a' k union all select timestamp'2024-01-01 10:50:00', 'a' union all select timestamp'2024-01-01 11:05:00', 'b'").write.json(str(tmp_path / "in"))
    out = counts_by_window(spark.readStream.schema(schema).json(str(tmp_path / "in")), "t", "k")
    stream = out.writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    stream.awaitTermination()
    assert sorted((r.k, r.n) for r in spark.table("windows").collect()) == [("a", 2), ("b", 1)]


def test_fuzzy_terms_by_brute_force(spark):
    turn = random.Random(3)
    word = lambda: "".join(turn.choice("abcdeä ") for _ in range(turn.randrange(1, 9)))
    terms = list(dict.fromkeys(word().strip() or "x" for _ in range(150)))
    known = match.Terms(terms)
    for t in [word().strip() for _ in range(200)]:
        if not t:
            continue
        exact = [x for x in terms if re.search(rf"(?<!\w){re.escape(x)}(?!\w)", t)]
        scores = [match.similarity(t, x) for x in terms]
        want = (exact[0], 100.0) if exact else (terms[scores.index(max(scores))] if max(scores) else None, float(max(scores)))
        assert known.best(t) == want
    # Whole numbers; a term between word edges goes before one that is a mere part.
    assert match.similarity("winterthur", "wintertur") == 95
    assert match.Terms(["inter", "b c"]).best("winter b c")[0] == "b c"
    df = spark.createDataFrame([("x " + t,) for t in terms], "t string")
    many = [r[0] for r in df.select(match.first_term(F.col("t"), terms)).collect()]
    few = [next((x for x in terms if re.search(rf"(?<!\w){re.escape(x)}(?!\w)", "x " + t)), None) for t in terms]
    assert many == few and len(terms) > match.BRANCHES
