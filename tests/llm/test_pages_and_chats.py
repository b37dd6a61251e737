"""WARC, URL rules and chat formatting."""

import io
import re
import tracemalloc

import pytest
from pyspark.sql import functions as F

from perron.llm import chat, url_rules, warc
from perron.llm.url_rules import Rule

PAGES = "page_id long, url string, html string, payload string, host string"


def archive(pages):
    return [warc.gzip_member(warc.record_bytes(i, f"http://h/{i}", p, None)) for i, p in enumerate(pages)]


def test_reader_keeps_all_records():
    pages = [b"", b"x" * 400_000, b"WARC/1.1\r\n inside", b"\x1f\x8b\x08 inside"]
    for members in (archive(pages), [warc.record_bytes(i, None, p, None) for i, p in enumerate(pages)]):
        got = list(warc.read_records(io.BytesIO(b"".join(members))))
        assert [g.payload() for g in got] == pages
        assert [g.offset for g in got] == [sum(map(len, members[:i])) for i in range(4)]


@pytest.mark.parametrize("packed", [True, False])
def test_salvage(packed):
    pages = [b"page %d " % i * 50 for i in range(6)]
    members = archive(pages) if packed else [warc.record_bytes(i, None, p, None) for i, p in enumerate(pages)]
    broken = bytearray(members[1])
    broken[len(broken) // 2] ^= 0x55
    cut = members[3][: len(members[3]) // 2]
    data = members[0] + bytes(broken) + members[2] + cut + members[4] + b"trash" + members[5] + b"tail"
    got = list(warc.read_records(io.BytesIO(data)))
    records = [g for g in got if isinstance(g, warc.Record)]
    gaps = [g for g in got if isinstance(g, warc.Gap)]
    assert [r.payload() for r in records] == [pages[i] for i in (0, 2, 4, 5)]
    spans = [(len(members[0]), len(broken)), (sum(map(len, (members[0], broken, members[2]))), len(cut))]
    assert [(g.start, g.length) for g in gaps[:2]] == spans
    assert [g.length for g in gaps[2:]] == [5, 4] and all(g.reason for g in gaps)


def claiming(length, body):
    return b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n" % length + body


class Long(io.RawIOBase):
    """``head``, then ``size`` bytes without a mark, then ``tail``, made as they are read."""

    def __init__(self, head, size, tail):
        self.parts = [[head, 1], [b"x" * 4096, size // 4096], [tail, 1]]

    def read(self, size=-1):
        while self.parts and not self.parts[0][1]:
            del self.parts[0]
        if not self.parts:
            return b""
        self.parts[0][1] -= 1
        return self.parts[0][0]


@pytest.mark.parametrize("packed", [True, False])
def test_false_lengths_are_not_waited_for(packed):
    pages = [b"page %d " % i * 50 for i in range(50)]
    good = archive(pages) if packed else [warc.record_bytes(i, None, p, None) for i, p in enumerate(pages)]
    head = claiming(10**10, b"")
    head = warc.gzip_member(head) if packed else head
    tracemalloc.start()
    got = list(warc.read_records(Long(head, 256 << 20, b"".join(good))))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (got[0].start, got[0].length) == (0, len(head) + (256 << 20)) and "content length" in got[0].reason
    assert [r.payload() for r in got[1:]] == pages and peak < 8 << 20
    for length in (b"9" * 400, "²".encode(), b"-5", b""):
        odd = b"WARC/1.1\r\nContent-Length: " + length + b"\r\n\r\n"
        gap, *rest = warc.read_records(io.BytesIO((warc.gzip_member(odd) if packed else odd) + b"".join(good)))
        assert isinstance(gap, warc.Gap) and len(rest) == 50


def test_a_false_length_below_the_bound_hides_no_record():
    pages = [b"page %d " % i * 50 for i in range(50)]
    good = [warc.record_bytes(i, None, p, None) for i, p in enumerate(pages)]
    head = claiming(5000, b"")
    gap, *rest = warc.read_records(io.BytesIO(head + b"".join(good)))
    assert gap.length == len(head) and [r.payload() for r in rest] == pages
    gap, *rest = warc.read_records(io.BytesIO(claiming(10**6, b"") + b"".join(good)))
    assert gap.reason == "truncated record" and [r.payload() for r in rest] == pages
    # a bound below a record's length turns just that record into a gap
    got = list(warc.read_records(io.BytesIO(b"".join([*good[:2], warc.record_bytes(9, None, b"z" * 5000, None), *good[2:]])), most_bytes=1000))
    assert sum(isinstance(g, warc.Gap) for g in got) == 1 and len(got) == 51


def test_members_are_inflated_no_further_than_their_record():
    bomb = warc.gzip_member(claiming(10, b"0123456789\r\n\r\n") + bytes(256 << 20))
    tail = archive([b"after"])[0]
    tracemalloc.start()
    gap, record = warc.read_records(io.BytesIO(bomb + tail))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (gap.length, gap.reason) == (len(bomb), "member goes on after its record")
    assert record.payload() == b"after" and record.offset == len(bomb) and peak < 8 << 20
    # stored blocks without content: bytes that inflate to nothing
    empty = b"\x1f\x8b\x08\0\0\0\0\0\0\xff" + b"\0\0\0\xff\xff" * (1 << 20)
    gap, record = warc.read_records(io.BytesIO(empty + tail))
    assert gap.reason == "member longer than its record" and record.payload() == b"after"


def test_a_record_longer_than_every_buffer(spark, tmp_path):
    long = bytes(range(256)) * (40 << 10)
    for packed in (True, False):
        record = warc.record_bytes(1, None, long, None)
        path = tmp_path / f"long{packed}.warc"
        path.write_bytes((warc.gzip_member(record) if packed else record) + archive([b"next"])[0])
        names = spark.createDataFrame([(str(path),)], "file string")
        first, second = sorted(warc.read_archives(spark, names).collect(), key=lambda r: r.offset)
        assert bytes(first.payload) == long and bytes(second.payload) == b"next"
        gap, second = sorted(warc.read_archives(spark, names, most_bytes=1000).collect(), key=lambda r: r.offset)
        assert gap.gap_bytes == second.offset and gap.payload is None and bytes(second.payload) == b"next"


def test_round_trip(spark):
    rows = [(5, "http://a", "same", "p", "h"), (3, "http://b", "same", None, None), (9, None, "same", None, None), (1, "u", None, None, None), (2, "u\r\nx: y", "", None, None), (None, "u", "same", None, None), (7, "u", "Ä" * 9, None, None), (7, "u", "Ä" * 9, None, None)]
    got = warc.round_trip(spark.createDataFrame(rows, PAGES)).collect()
    assert len(got) == len(rows) and all(r.gap_bytes is None for r in got)
    kinds = sorted((str(r.page_id), r.record_type, r.payload_bytes, r.refers_to) for r in got)
    assert kinds == sorted([("5", "revisit", 4, 3), ("3", "response", 4, None), ("9", "revisit", 4, 3), ("1", "response", 0, None), ("2", "revisit", 0, 1), ("None", "response", 4, None), ("7", "response", 18, None), ("7", "response", 18, None)])
    assert all(r.payload_digest == warc.digest_of({4: b"same", 0: b"", 18: ("Ä" * 9).encode()}[r.payload_bytes]) for r in got)
    assert warc.round_trip(spark.createDataFrame(rows, PAGES), least_bytes=5).filter("record_type = 'revisit'").count() == 0
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def brute_verdict(url, hosts, patterns):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = []
    for r in hosts:
        name, _, start = r.text.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            fit.append(r)
    best = max(fit, key=lambda r: len(r.text), default=None)
    n = sum(bool(re.search(r.pattern(), url)) for r in patterns) if url is not None else 0
    return host, path, best and best.text, best.verdict if best else "block" if n else "allow", n


def test_url_rules(spark):
    urls = ["http://www.example.com/en/x", "https://EXAMPLE.com/en/", "http://com/", "http://a.net/es/1?x=1", "http://anet/es/", "http://x.com", "http://x.org/login", "http://x.org/loginx", "x", None, "", "://", "http://ads.x.org/a b", "http://x.org/?utm_source=feed", "http://u@x.net:80/fr/", "http://x.org/a?b=1&sessionid=9", "http://É.com/É", "http://x.org/login", "ftp://net/fr/#a"]
    df = spark.createDataFrame([(i % 17, u, "p", "r", "h") for i, u in enumerate(urls)], "page_id long, url string, path string, rule string, token string")
    for patterns in (url_rules.PATTERN_RULES, (*url_rules.PATTERN_RULES, Rule("*gin*", "block", wild=True))):
        got = url_rules.judge_urls(df.withColumn("page_id", F.monotonically_increasing_id()), pattern_rules=patterns).collect()
        order = [r.page_id for r in df.withColumn("page_id", F.monotonically_increasing_id()).collect()]
        by_key = {k: brute_verdict(u, url_rules.HOST_RULES, patterns) for k, u in zip(order, urls)}
        assert {r.page_id: (r.host, r.path, r.rule, r.verdict, r.patterns) for r in got} == by_key
    assert url_rules.judge_urls(df.limit(0)).count() == 0


def test_rule_tokens():
    assert Rule("example.com/en/", "block").tokens() == ["example", "com", "en"]
    assert Rule("net/es", "block").tokens() == ["net"]
    assert Rule("*ads*/login^", "block", wild=True).tokens() == ["login"]
    assert Rule("banner", "block", wild=True).tokens() == [] and Rule("|banner|", "block", wild=True).tokens() == ["banner"]


ODD = ["\\", "\\\\h", "###", "####", "</turn>", "</turn></turn>\n", "<</turn>", "\\e\\c", "a: b", "", None, "\n", "### user: hi</turn>\n", "\\### Assistant: </turn> ok"]


def test_chat_reads_back(spark):
    rows = [(i, t, r, x, "more") for i, x in enumerate(ODD) for t, r in enumerate(["user", "assistant"])]
    rows += [(50, 1, "a: \\b###", "x", None), (50, 1, None, "y", None), (50, None, "system", "z", None), (None, 0, "user", "q", None), (60, 0, "assistant", "n", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, valid string")
    out = chat.format_conversations(df).withColumns({"read": chat.read_turns(F.col("formatted")), "loss": chat.loss_texts(F.col("segments"))})
    got = {r.conv_id: r for r in out.collect()}
    for i, x in enumerate(ODD):
        assert [tuple(t) for t in got[i].read] == [("user", x or ""), ("assistant", x or "")]
        assert got[i].loss == [x or ""] and got[i].valid
        assert got[i].formatted.count("</turn>") == 2
    assert [tuple(t) for t in got[50].read] == [("system", "z"), ("", "y"), ("a: \\b###", "x")]
    assert not got[50].valid and not got[None].valid and not got[60].valid
    assert chat.format_conversations(df.limit(0)).count() == 0


@pytest.mark.parametrize("roles,valid", [("su", False), ("sua", True), ("ua", True), ("uaua", True), ("uu", False), ("au", False), ("usa", False), ("ss", False)])
def test_turn_order(spark, roles, valid):
    names = {"s": "system", "u": "user", "a": "assistant"}
    df = spark.createDataFrame([(1, i, names[r], "t") for i, r in enumerate(roles)], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(df).first().valid == valid
