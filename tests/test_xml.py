"""Feeds and sitemaps by Spark's reader against a plain parser."""

import random
from xml.etree import ElementTree

import pytest

from tidemill.sources import xml

SPACE = "http://www.itunes.com/dtds/podcast-1.0.dtd"


def feed(rng, n):
    title = lambda k: rng.choice([f"Tom &amp; J{k}", f"<![CDATA[<b>{k} & co]]>", f" x{k}\n", "", "&#x41;&#66;" + str(k)])
    enclosure = lambda k: rng.choice(["", f"<enclosure url='https://a.b/{k}?b=1&amp;c=2' length='{k}'/>", f'<enclosure length="" url="http://x.y/{k}"/>', '<enclosure url="file:///etc/passwd" length="7"/>', "<enclosure/>", f'<enclosure url="HTTPS://a.b/{k}"></enclosure>'])
    items = "".join(f"<item><title lang='x'>{title(k)}</title><itunes:title>no</itunes:title>{rng.choice(['', '<itunes:duration>1:02:03</itunes:duration>', '<itunes:duration>61</itunes:duration>'])}{enclosure(k)}<pubDate> d{k} </pubDate></item>\n" for k in range(n))
    return f"<?xml version='1.0' encoding='UTF-8'?>\n<rss xmlns:itunes='{SPACE}'><channel><title>All</title><!-- <item><title>no</title></item> -->{items}</channel></rss>"


def plain(content):
    out = []
    for k, it in enumerate(ElementTree.fromstring(content.encode()).iter("item")):
        enc, dur = it.find("enclosure"), it.findtext(f"{{{SPACE}}}duration", "")
        parts = [int(p) for p in dur.split(":") if p]
        url = enc.get("url") if enc is not None else None
        url = url if url and url.lower().startswith(("http://", "https://")) else None
        out.append((k, it.findtext("title", "").strip(), it.findtext("pubDate", "").strip(), sum(p * 60**i for i, p in enumerate(reversed(parts))) if parts else None, url, int(enc.get("length") or 0) if enc is not None else None))
    return out


def test_feeds(spark, tmp_path):
    rng = random.Random(4)
    texts = {f"f{k}": feed(rng, n) for k, n in enumerate((40, 0, 1, 300))}
    for name, content in texts.items():
        (tmp_path / f"{name}.xml").write_text(content, encoding="utf-8")
    want = {(name, *r) for name, content in texts.items() for r in plain(content)}
    shown = ("pos", "title", "pub_date", "duration_s", "enclosure", "bytes")
    by_file = {(r["file"].rsplit("/", 1)[1][:-4], *(r[c] for c in shown)) for r in xml.feed_rows(spark, str(tmp_path)).collect()}
    in_rows = {(r["file"], *(r[c] for c in shown)) for r in xml.feed_items(spark.createDataFrame(list(texts.items()), "file string, content string")).collect()}
    assert by_file == in_rows == want and len(want) == 341


@pytest.mark.parametrize("content", ["<rss><channel><item><title>x</title></item><item>broken", "<rss><channel><item><title>a & b</title></item></channel></rss>", "<rss><item></title></item></rss>"])
def test_broken_feeds_are_refused(spark, tmp_path, content):
    (tmp_path / "b.xml").write_text(content)
    with pytest.raises(Exception):
        xml.feed_rows(spark, str(tmp_path)).collect()
    with pytest.raises(Exception):
        xml.feed_items(spark.createDataFrame([("b", content)], "file string, content string")).collect()


def test_sitemaps(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "s.xml").write_text("<?xml version='1.0'?><s:urlset xmlns:s='urn:x'><s:url><s:loc>\n https://e.com/?a=1&amp;b=2 </s:loc><s:lastmod>2024-03-01T00:00Z</s:lastmod></s:url><s:url><s:loc><![CDATA[https://e.com/&]]></s:loc></s:url><s:url><s:lastmod>2024</s:lastmod></s:url></s:urlset>")
    got = [tuple(r)[1:] for r in xml.sitemap_rows(spark, str(tmp_path / "a")).orderBy("pos").collect()]
    assert got == [(0, "https://e.com/?a=1&b=2", "2024-03-01"), (1, "https://e.com/&", None)]
    (tmp_path / "i.xml").write_text("<sitemapindex><sitemap><loc>https://e.com/1.xml</loc></sitemap><sitemap><loc>https://e.com/2.xml</loc></sitemap></sitemapindex>")
    assert [r["url"] for r in xml.sitemap_rows(spark, str(tmp_path / "i.xml"), "sitemap").orderBy("pos").collect()] == ["https://e.com/1.xml", "https://e.com/2.xml"]
