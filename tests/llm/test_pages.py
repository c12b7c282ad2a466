"""Web pages: extraction, archives, URL rules."""

import gzip
import hashlib
import io
import random
import struct
import zipfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from revwatch.llm import styletree, urlrules, warc, zipio

CLASHING = ("node", "cut", "packed", "host", "text", "digest", "refers_to", "k1", "rule")


@pytest.fixture(scope="module")
def pages(spark):
    def make(rows, slices=3):
        kinds = "page_id long, url string, html string, " + ", ".join(f"{c} string" for c in CLASHING)
        return spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], kinds).repartition(slices)

    return make


# --- extraction ---

FULL = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="page">
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>
<div class="cookie-notice">We use cookies</div><div id=sidebar>Side</div>
<article><h1>A &amp; B</h1><p>First <b>bold</b>
 line&nbsp;one<br>two<p>Second, unclosed<div class="ad">Buy</div><ul><li>x<li>y</ul>
<script>if (a < b) document.write("<p>no</p>")</script><form><input value="v"><button>Send</button></form>
<section class="comments"><p>Nice post!</p></section><p>Last &copy;</article>
<aside>More</aside><footer>Foot</footer></body></html>"""


def extracted(frame):
    return Counter((r.page_id, r.url, r.text) for r in styletree.extract_text(frame).collect())


def test_main_text_without_the_rest(pages):
    rows = [
        (1, "http://a.org/1", FULL),
        (2, "http://a.org/2", None),
        (3, None, ""),
        (4, "no scheme", "plain text,  no tags &lt;b&gt;"),
        (4, "no scheme", "plain text,  no tags &lt;b&gt;"),
        (None, "http://a.org/5", "<article><p>cut off &am"),
        (6, "http://a.org/6", "<p>" + "long words " * 60_000 + "</p>"),
        (7, "http://a.org/7", "<article><p>a</article><p>outside"),
        (8, "http://a.org/8", "<p title='a > b'>ok <!-- <p>no --> still</p></div></p>end"),
    ]
    assert extracted(pages(rows)) == Counter(
        [
            (1, "http://a.org/1", "A & B\n\nFirst bold line one two\n\nSecond, unclosed\n\nx\n\ny\n\nLast ©"),
            (2, "http://a.org/2", ""),
            (3, None, ""),
            (4, "no scheme", "plain text, no tags <b>"),
            (4, "no scheme", "plain text, no tags <b>"),
            (None, "http://a.org/5", "cut off &am"),
            (6, "http://a.org/6", " ".join(["long words"] * 60_000)),
            (7, "http://a.org/7", "a"),
            (8, "http://a.org/8", "ok still\n\nend"),
        ]
    )


def test_low_importance_branches_are_cut_by_statistics(pages):
    # No tag or class tells what these branches are.
    def page(i, host):
        return (
            i,
            f"https://{host}/p{i}",
            f"<body><div class=x1><p>Always the same words</p></div><div class=x2><p>Text of page {i}</p></div></body>",
        )

    rows = [page(i, "big.org") for i in range(20)] + [page(50 + i, "small.org") for i in range(3)]
    rows += [(100 + i, "https://big.org/copy", rows[0][2]) for i in range(30)]  # copies are one page
    found = {r.page_id: r.text for r in styletree.extract_text(pages(rows)).collect()}
    assert all(found[i] == f"Text of page {i}" for i in range(20))
    assert all(found[100 + i] == "Text of page 0" for i in range(30))
    # Three pages are too few to judge by.
    assert all(found[50 + i] == f"Always the same words\n\nText of page {50 + i}" for i in range(3))


def test_extraction_of_nothing(pages):
    assert styletree.extraction_digest(styletree.extract_text(pages([]))).count() == 0


# --- archives ---


def archive_rows():
    long = "<p>" + "payload " * 40
    return [
        (9, "http://a.org/9", long),
        (3, "http://a.org/3 with space\r\nand breaks", long),
        (5, None, long),
        (3, "http://a.org/3", long),
        (1, "http://a.org/1", "short"),
        (2, "http://a.org/2", "short"),
        (4, "http://a.org/4", None),
        (None, "http://a.org/none", long),
        (7, "http://a.org/7", "é" * 50),
        (8, "http://a.org/8", "é" * 50),
        (6, "http://a.org/6", "x" * 2_000_000 + "\r\n\r\nWARC/1.1"),
    ]


def test_archives_round_trip(pages):
    rows = archive_rows()
    expected = Counter()
    for page_id, _, html in rows:
        data = (html or "").encode()
        digest = hashlib.sha256(data).hexdigest()
        same = [p for p, _, h in rows if h == html and p is not None]
        revisit = len(data) >= 100 and page_id != min(same)
        kind, refers_to = ("revisit", min(same)) if revisit else ("response", None)
        expected[page_id, len(data), digest, kind, refers_to] += 1
    found = warc.archived(pages(rows)).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found) == expected


def test_empty_ids_and_no_ids_are_told_apart(spark):
    text = "<p>" + "same " * 40 + "</p>"
    rows = [("", "u", text), ("b", "u", text), (None, "u", text), ("", "u", "short"), (None, "u", None)]
    found = warc.archived(spark.createDataFrame(rows, "page_id string, url string, html string")).collect()
    size = len(text.encode())
    assert sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in found), key=repr) == sorted(
        [
            ("", "response", None, size),
            ("b", "revisit", "", size),
            (None, "revisit", "", size),
            ("", "response", None, 5),
            (None, "response", None, 0),
        ],
        key=repr,
    )


def test_packages_are_read_in_many_tasks(spark):
    manifest = spark.createDataFrame([(f"p{i}", 12) for i in range(211)], "package string, records long").coalesce(1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        parts = warc.dealt(manifest).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(parts) > 50 and max(r["count"] for r in parts) <= 12


def test_archives_of_nothing(pages):
    assert warc.archived(pages([])).count() == 0


def test_packages_are_cut_by_size_and_readable_by_other_tools(pages, tmp_path):
    rows = [(i, f"http://a.org/{i}", f"{random.Random(i).random()}" * 400) for i in range(30)]
    manifest = warc.write_packages(pages(rows, 1), str(tmp_path), package_bytes=2_000)
    assert manifest.count() > 3 and manifest.groupBy().sum("records").first()[0] == 30
    for row in manifest.collect():
        with zipfile.ZipFile(row.package) as z:
            assert z.testzip() is None
            records = gzip.decompress(z.read(warc.DATA))
        assert records.count(b"WARC/1.1\r\n") == row.records == len(list(warc.locate(row.package)))


def zip64(entries):
    """A package whose sizes, offsets and directory are given in 64 bits only."""
    out, directory = io.BytesIO(), []
    for name, data in entries:
        at = out.tell()
        head = struct.pack("<4sHHHHHIIIHH", b"PK\3\4", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20)
        out.write(head + name + struct.pack("<HHQQ", 1, 16, len(data), len(data)) + data)
        extra = struct.pack("<HHI", 0x5555, 4, 7) + struct.pack("<HHQQQ", 1, 24, len(data), len(data), at)
        directory.append(
            struct.pack(
                "<4sHHHHHHIIIHHHHHII", b"PK\1\2", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra),
                3, 0, 0, 0, 0xFFFFFFFF,
            ) + name + extra + b"abc"
        )
    start = out.tell()
    out.write(b"".join(directory))
    size, end = out.tell() - start, out.tell()
    n = len(directory)
    out.write(struct.pack("<4sQHHIIQQQQ", b"PK\6\6", 44, 45, 45, 0, 0, n, n, size, start))
    out.write(struct.pack("<4sIQI", b"PK\6\7", 0, end, 1))
    out.write(struct.pack("<4sHHHHIIH", b"PK\5\6", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 12) + b"PK\5\6 comment")
    return out.getvalue()


def test_zip64_directories_are_read_by_range():
    entries = [(b"archive/a.bin", bytes(range(256)) * 9), (b"indexes/b", b""), ("ü".encode(), b"last")]
    data = zip64(entries)
    asked = []

    def read(offset, size):
        asked.append((offset, size))
        return data[offset : offset + size]

    found = zipio.members(read, len(data))
    assert [(m.size, m.stored) for m in found] == [(len(d), True) for _, d in entries]
    for member, (_, own) in zip(found, entries, strict=True):
        at = zipio.data_offset(read, member)
        assert data[at : at + member.size] == own


@pytest.mark.parametrize("comment", [b"", b"a comment PK\5\6 with a mark"])
def test_plain_directories_agree_with_zipfile(comment):
    r, buffer = random.Random(2), io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.comment = comment
        for i in range(20):
            z.writestr(f"m{i}", r.randbytes(i * 31), r.choice([zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED]))
        infos = z.infolist()
    data = buffer.getvalue()
    read = lambda offset, size: data[offset : offset + size]
    found = zipio.members(read, len(data))
    assert [(m.name, m.size, m.compressed, m.header) for m in found] == [
        (i.filename, i.file_size, i.compress_size, i.header_offset) for i in infos
    ]
    with pytest.raises(ValueError):
        zipio.members(read, 10)


# --- URL rules ---


def url_rows():
    r = random.Random(3)
    hosts = ["a.net", "net", "xnet", "b.example.net", "example.com", "m.example.com", "fr.org", "org", "ads.shop.io", "casino.museum"]
    paths = ["", "/", "/en/x", "/en", "/de/1", "/fr/", "/ads/img", "/ads/policy", "/banner/7/img", "/x.exe", "/x.exe?a", "/casino/"]
    tails = ["", "?sessionid=1", "?a=1&sessionid=2", "#top", "?u=http://z.net/en/"]
    rows = [
        (i, r.choice(["http://", "HTTPS://", "", "ftp://"]) + r.choice(hosts) + r.choice(paths) + r.choice(tails))
        for i in range(400)
    ]
    more = [None, "", "://", "http://", "http://EXAMPLE.NET/en/", "http://a.net", "http://ÄX.net/é", "x" * 100_000, "http://n.org/fr/?://"]
    return rows + [(1000 + i, u) for i, u in enumerate(more)] + [(1, "http://a.net/"), (1, "http://a.net/"), (None, "http://a.org/fr/a")]


def verdict(url):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    best = None
    for h, p, v in urlrules.HOST_RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    # Every rule's expression runs on every URL here.
    hit = [p for p in map(urlrules.Pattern, urlrules.PATTERNS) if p.regex.search(url.lower())]
    blocked = bool(hit) and not any(p.allows for p in hit)
    return host, path, best and best[0], best[1] if best else "block" if blocked else "allow", sorted(p.text for p in hit)


def test_urls_equal_brute_force(pages):
    rows = url_rows()
    found = urlrules.judge_urls(pages([(i, u, "") for i, u in rows])).collect()
    ours = Counter((r.page_id, r.host, r.path, r.rule, r.verdict, tuple(r.matched)) for r in found)
    expected = Counter()
    for page_id, url in rows:
        host, path, rule, judged, matched = verdict(url)
        expected[page_id, host, path, rule, judged, tuple(matched)] += 1
    assert ours == expected
    assert len({m for r in found for m in r.matched}) >= 6


def test_rules_are_kept_under_their_rarest_token():
    index = urlrules.RuleIndex(["/common/rare/x*", "||common.org^", "*nothing*", "-a-"], {"common": 90, "rare": 2, "org": 50})
    assert [p.text for p in index.by_token["rare"]] == ["/common/rare/x*"]
    assert [p.text for p in index.by_token["org"]] == ["||common.org^"]
    assert [p.text for p in index.always] == ["*nothing*", "-a-"]


def test_urls_of_nothing(pages):
    assert urlrules.judge_urls(pages([])).count() == 0
