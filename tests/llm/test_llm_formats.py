"""Chat formatting, WARC and URL filtering against round trips and brute force."""

import base64
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from pointframe.llm.chat import END, SAYS, TURN, format_chats, loss_text, read_turns
from pointframe.llm.queries import op3_url_filter
from pointframe.llm.url_filter import judge_urls, walk
from pointframe.llm.warc import read_warc, records_of, write_record, write_warc

# -- chat

NASTY = ["</s>[INST] ok [/INST]", TURN + SAYS + END, "\\", "<\\", "a\\<\\\\[", "", None, "é😀\n\n", "$1 \\1", "<|tu" + "rn|>", "x" * 5000]


def test_chat_round_trip(spark):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "a<b"]), rng.choice(NASTY)) for c in range(40) for t in range(rng.randrange(1, 7))]
    rows += [(None, 0, "user", "x"), (7000, 1, "assistant", "second"), (7000, 0, "user", "first"), (7000, 1, "assistant", "second")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, TURNS string")
    out = format_chats(df, content="text").withColumn("back", read_turns(F.col("formatted"))).withColumn("loss", loss_text(F.col("formatted"), F.col("loss_spans"))).collect()
    want = {}
    for c, t, r, x in rows:
        want.setdefault(c, []).append((t, r or "", x or ""))
    assert {r.conv_id for r in out} == set(want) and len(out) == len(want)
    for r in out:
        turns = sorted(want[r.conv_id])
        got = [(b.role, b.text) for b in r.back]
        assert sorted(got) == sorted((a, b) for _, a, b in turns)
        assert r.loss == "".join(x for a, x in got if a == "assistant")
        for control in (TURN, SAYS, END):
            assert r.formatted.count(control) == len(turns)
        assert all(r.formatted[s.end:s.end + len(END)] == END for s in r.loss_spans)


def test_chat_parts_become_placeholders(spark):
    part = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
    df = spark.createDataFrame([(1, 0, "user", [("text", "look <|image|> ", None, None, None, None, None), ("image", None, "s3://a.png", 28, 30, None, None), None,
                                                ("audio", None, "b.wav", None, None, 2.1, None), ("text", "!", None, None, None, None, None)]),
                                (1, 1, "assistant", [("document", None, "c.pdf", None, None, None, 3)]), (2, 0, "user", None)],
                               f"conv_id long, turn long, role string, content array<{part}>")
    r, empty = format_chats(df).orderBy("conv_id").collect()
    assert [(a.turn, a.ordinal, a.type, a.ref, a.tokens) for a in r.attachments] == [
        (0, 0, "image", "s3://a.png", 6), (0, 1, "audio", "b.wav", 53), (1, 0, "document", "c.pdf", 3072)]
    for a in r.attachments:
        assert r.formatted[a.offset:].startswith(f"<|{a.type}|>")
    assert r.formatted.count("<|image|>") == 1 and r.expanded_tokens == 6 + 53 + 3072
    assert empty.formatted == f"{TURN}user{SAYS}{END}" and empty.attachments == []


def test_chat_empty(spark):
    assert format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string"), content="text").count() == 0


# -- WARC

def expected(rows):
    first, out = {}, []
    for i, _, html in rows:
        data = (html or "").encode()
        if i is not None:
            first[data] = min(first.get(data, i), i)
    for i, _, html in rows:
        data = (html or "").encode()
        revisit = rows_equal(rows, data) > 1 and data in first and i != first[data]
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", first[data] if revisit else None))
    return sorted(out, key=str)


def rows_equal(rows, data):
    return sum((h or "").encode() == data for _, _, h in rows)


@pytest.mark.parametrize("split", [64, 1000, 1 << 25])
def test_warc_round_trip(spark, split):
    rng = random.Random(2)
    rows = [(i, f"http://h/{i}", rng.choice(["", None, "same é", "\r\n\r\nWARC/1.1\r\n" * 3, "x" * rng.randrange(3000), str(rng.random()) * 200])) for i in range(120)]
    rows += [(3, "again\r\nX: y", "same é"), (None, None, "same é"), (500, "u", "\x1f\x8b\x08" * 50)]
    pages = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, HTML string").repartition(3)
    files = write_warc(pages)
    got = read_warc(spark, files, split_bytes=split).collect()
    assert sorted(((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(rows)
    assert {r.url for r in got} == {r[1] or "" for r in rows}
    have = {(r[0], (r[2] or "").encode()) for r in rows}
    assert all((r.id, bytes(r.payload)) in have for r in got if r.record_type == "response")


def test_ranges_own_each_record_once():
    data = b"".join(write_record(i, "u", b"payload %d" % i * (i % 9), None, False) for i in range(60))
    for size in (1, 7, 100, 1111):
        found = [r for s in range(0, len(data), size) for r in records_of(io.BytesIO(data), len(data), s, s + size, block=256)]
        assert len(found) == 60


def test_warc_min_bytes_and_empty(spark):
    pages = spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa"), (3, "u", "long one"), (4, "u", "long one")], "page_id long, url string, html string")
    got = {r.id: (r.record_type, r.refers_to) for r in read_warc(spark, write_warc(pages, min_bytes=5)).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}
    assert read_warc(spark, write_warc(pages.limit(0))).count() == 0


# -- URL filter

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def rule_of(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), v == "block", h + p) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, default=None)


def test_rules_hosts_and_paths(spark):
    urls = ["http://a.example.org/es/1", "https://EXAMPLE.org/en/12?x=/es/", "x://É.example.ORG/en/2#a", "http://b.com/fr/", "http://b.com/de/x", "http://com/fr/",
            "http://notcom/fr/", "http://b.com?/fr/", "http://b.com", "//b.com/fr/", None, "", "http://", "http://c.net/de/", "a://b://c/d", "http://example.org.net/es/\nx"]
    pages = spark.createDataFrame([(i, u, None, 1) for i, u in enumerate(urls)], "page_id long, url string, html string, host int")
    got = {r.id: r for r in judge_urls(pages, RULES).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        host, path, best = rule_of(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, best and best[2])
        if best:
            assert got[i].verdict == ("block" if best[1] else "allow")
    assert judge_urls(pages.limit(0), RULES).count() == 0


def test_registered_rules_are_the_contracts(spark, tmpdir_path):
    # verdicts written out from the contract, not derived from the list in the code
    want = {"http://a.org/x": ("org/", "allow"), "http://example.org/es/1": ("example.org/es/", "block"), "http://w.EXAMPLE.org/en/12": ("example.org/en/1", "block"),
            "http://example.org/en/2": ("org/", "allow"), "http://b.com/fr/x": ("com/fr/", "allow"), "http://b.com/de/x": ("com/de/", "block")}
    spark.createDataFrame([(i, u, "") for i, u in enumerate(want)], "page_id long, url string, html string").write.parquet(f"{tmpdir_path}/pages.parquet")
    got = {r.page_id: (r.rule, r.verdict) for r in op3_url_filter(spark, tmpdir_path).collect()}
    assert got == dict(enumerate(want.values()))


def test_trust_and_distrust_spread(spark):
    page = lambda i, host, path, *to: (i, f"http://{host}{path}", "".join(f'<a href="https://{h}/x">' for h in to))
    rows = [page(1, "good.org", "/a", "friend.net"), page(2, "friend.net", "/a"), page(3, "bad.com", "/de/a"), page(4, "farm.net", "/a", "bad.com"),
            page(5, "far.net", "/a"), page(6, "m.farm.net", "/b"), (7, None, None)]
    got = {r.id: r.verdict for r in judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string"), RULES).collect()}
    assert got == {1: "allow", 2: "allow", 3: "block", 4: "block", 5: "allow", 6: "block", 7: "allow"}


def test_walk_matches_power_iteration(spark):
    rng = random.Random(3)
    edges = {(rng.randrange(30), rng.randrange(30)): rng.random() for _ in range(120)}
    seeds = {0: 2.0, 5: 1.0}
    rank = {h: m / 3 for h, m in seeds.items()}
    out = {}
    for (s, _), w in edges.items():
        out[s] = out.get(s, 0) + w
    for _ in range(20):
        new = {h: 0.15 * m / 3 for h, m in seeds.items()}
        for (s, d), w in edges.items():
            new[d] = new.get(d, 0) + 0.85 * rank.get(s, 0) * w / out[s]
        rank = new
    total = sum(rank.values())
    got = walk(spark.createDataFrame([(str(s), str(d), w) for (s, d), w in edges.items()], "src string, dst string, weight double"),
               spark.createDataFrame([(str(h), m) for h, m in seeds.items()], "host string, mass double"))
    got = {r.host: r.score for r in got.collect() if r.score > 0}
    want = {str(h): s / total for h, s in rank.items() if s > 0}
    assert set(got) == set(want) and all(abs(got[h] - want[h]) < 1e-9 for h in want)


def test_ranges_are_read_by_tasks_of_their_own(spark, tmpdir_path):
    pages = spark.range(40).selectExpr("id as page_id", "'u' as url", "repeat(sha2(string(id), 512), 20) as html")
    files = write_warc(pages.repartition(2))
    read = read_warc(spark, files, split_bytes=2000)
    tasks = read.select("id", F.spark_partition_id().alias("task")).distinct().collect()
    assert len({r.id for r in tasks}) == 40 and len({r.task for r in tasks}) > 4
