"""Main text: broken markup, named furniture, template found by entropy alone, edge cases."""

import html
import re

import pytest
from pyspark.sql import functions as F

from curbline.llm import html_main
from curbline.llm.common import table


@pytest.mark.parametrize("page,text", [
    ("", ""), (None, ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b", "a\n\nb"), ("<p>a<br>b<p>  </p>", "a b"),
    ("<ul><li>a<li>b</ul>c", "a\n\nb\n\nc"), ("<table><tr><td>1<td>2<tr><th>3</table>", "1\n\n2\n\n3"),
    ("<b>x<p>y</b>z", "x\n\nyz"), ("a<!-- <p>no</p> -->b", "ab"), ("<p>1 < 2 &lt; 3</p>", "1 < 2 < 3"),
    ("<script>var a='</p><p>no'</script>yes<style>p{}</style>", "yes"), ("<p title='a>b'>q</p>", "q"),
    ("<P CLASS=x>Up</P>", "Up"), ("a&nbsp;&nbsp;b\t\nc", "a b c"), ("<article><header><h1>T</h1></header><p>x</p></article>", "T\n\nx"),
    ("<header>no</header><main>yes</main>", "yes"), ("<div class='comments'>no</div><div id=cookie-notice>no</div>ok", "ok"),
    ("<div class='adventure'>kept</div>", "kept"), ("<aside>no</aside><form>no<input></form><nav>no</nav>yes<footer>no", "yes"),
    ("<p>one</div>two</p>", "onetwo"), ("&#233;&eacute;&#x65e5;", "éé日"), ("<p title='the hidden gem'>seen</p><p hidden>no</p>", "seen"),
    ("<article><p>never <b>ends", "never ends"), ("<textarea>no</textarea><button>no</button>x", "x"), ("<p>a</p", "a"),
])
def test_blocks(page, text):
    assert html_main.main_text(page) == text


def page(k, body):
    return (f"<html><body><div class=top><p>Welcome to our site.</p><p>All offers.</p></div><div class=x><p>{body}</p></div>"
            f"<div class=z><p>Back to start.</p></div></body></html>")


def test_template_without_telling_names(spark):
    rows = [(k, f"http://site.net/{k}", page(k, f"Story {k} says something of its own. It goes on {k * 7}.")) for k in range(12)]
    rows += [(100, "http://small.net/1", page(1, "Only one page here.")), (101, None, page(2, "No url.")),
             (102, "http://site.net/e", None), (103, "http://site.net/e", ""), (None, "http://site.net/n", rows[3][2]), rows[3]]
    df = (spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
          .withColumn("noise", F.lit(1)).withColumn("text", F.lit("clash")))
    found = html_main.extract(df).collect()
    assert len(found) == len(rows)
    texts = {r["page_id"]: r["text"] for r in found}
    for k in range(12):
        assert texts[k] == f"Story {k} says something of its own. It goes on {k * 7}."
    assert "Only one page here." in texts[100] and "No url." in texts[101]
    assert texts[102] == texts[103] == "" and texts[None] == texts[3]


def test_repeated_articles_stay(spark):
    body = "<html><body><article><p>The same notice on every page.</p></article></body></html>"
    df = spark.createDataFrame([(k, f"http://s.net/{k}", body) for k in range(20)], "page_id long, url string, html string")
    assert {r["text"] for r in html_main.extract(df).collect()} == {"The same notice on every page."}
    assert html_main.extract(df.where("false")).count() == 0


def test_statistics_are_entropies(spark):
    bodies = ["<div><p>same text</p><p>own one</p></div>", "<div><p>same text</p></div>"]
    df = spark.createDataFrame([("h", b) for b in bodies], "host string, html string")
    rows = {r["place"]: r for r in html_main.site_statistics(df).collect()}
    paragraph = rows["/div/p"]
    # "same text" on both pages: entropy 1; "own one" on one: 0
    assert paragraph["pages"] == 2 and paragraph["content"] == pytest.approx(0.5)
    assert rows[""]["presentation"] == pytest.approx(0.0)


@pytest.mark.parametrize("around", [
    "<div class='content-sidebar-wrap'><main>{}</main></div>", "<div class='layout has-sidebar'><article>{}</article></div>",
    "<div class='elementor-widget elementor-widget-text-editor'><p>{}</p></div>"])
@pytest.mark.parametrize("pages", [1, 8])
def test_names_are_evidence_only(spark, around, pages):
    """Wrappers with telling names keep their article; a named place that repeats itself goes."""
    rows = [(k, f"http://s.net/{k}", "<body>" + around.format(f"Story {k} of its own.")
             + "<div class='sidebar'><p>Same on all pages.</p></div></body>") for k in range(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r["page_id"]: r["text"] for r in html_main.extract(df).collect()}
    for k in range(pages):
        assert texts[k] == f"Story {k} of its own."


@pytest.mark.parametrize("pages", [1, 3, 40])
def test_named_furniture_goes_on_hosts_of_any_size(spark, pages):
    """Adverts, notices, comments and sidebars whose words differ from page to page, beside and inside an article."""
    body = ("<body><div class='cookie-notice'>We use cookies {0}.</div><div class='wrap has-sidebar'>"
            "<article><h1>Title {0}</h1><p>First words of story {0}.</p><div class='ad'>Buy {0} now</div><p>The end of {0}.</p>"
            "</article><div class='sidebar'><p>Other news {0}</p></div></div>"
            "<div id='comments'><p>Reader {0} says no.</p></div></body>")
    plain = ("<body><div class='ad-box'><p>Cheap things {0}</p></div><div class='text'><p>A page {0} without an article element, "
             "whose text is the longest part of it by far.</p></div><section class='comments'><p>I like {0}.</p></section></body>")
    rows = [(k, f"http://a.net/{k}", body.format(k)) for k in range(pages)]
    rows += [(100 + k, f"http://b.net/{k}", plain.format(k)) for k in range(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r["page_id"]: r["text"] for r in html_main.extract(df).collect()}
    for k in range(pages):
        assert texts[k] == f"Title {k}\n\nFirst words of story {k}.\n\nThe end of {k}."
        assert texts[100 + k] == f"A page {k} without an article element, whose text is the longest part of it by far."


def test_no_advert_in_the_given_pages(spark):
    """Whole pages table: no text of a branch named as an advert; every article paragraph is there."""
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    found = {r["page_id"]: r["text"] for r in html_main.extract(pages).collect()}
    adverts = 0
    for r in pages.collect():
        blocks = found[r["page_id"]].split("\n\n")
        beside = re.sub(r"<[^>]*>", "\n", re.sub(r"<div class=[\"']?ad[\"']?[^>]*>.*?</div>", "", r["html"] or "", flags=re.S))
        for advert in re.findall(r"<div class=[\"']?ad[\"']?[^>]*>(.*?)</div>", r["html"] or "", re.S):
            words = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", advert)).split())
            adverts += bool(words)
            assert words not in blocks or words in html.unescape(beside), r["page_id"]  # an article may say the same
    assert adverts > 50 and sum(map(bool, found.values())) > 0.9 * len(found)


def test_copies_are_no_template(spark):
    """Copies of one article in a wrapper, with one line of their own; copies of a page count once."""
    wrapped = ("<body><div class=wrap><article><p>The text of all copies.</p></article></div>"
               "<p class=link>Permalink {}.</p></body>")
    plain = "<body><div class=post><p>Words in a plain place.</p></div></body>"
    rows = [(k, f"http://a.net/{k}", wrapped.format(k)) for k in range(12)]
    rows += [(k, f"http://b.net/{k}", plain) for k in range(20, 32)]
    rows += [(40, "http://b.net/o", "<body><div class=other><p>One other page.</p></div></body>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r["page_id"]: r["text"] for r in html_main.extract(df).collect()}
    for k in range(12):
        assert texts[k] == f"The text of all copies.\n\nPermalink {k}."
    assert {texts[k] for k in range(20, 32)} == {"Words in a plain place."}


def test_numbered_names_are_one_place(spark):
    bodies = [f"<div class='post post-{k}'><p id=c{k}>Text {k}.</p><p id='u-{k:06x}a9'>x</p></div>" for k in range(50)]
    df = spark.createDataFrame([("h", b) for b in bodies], "host string, html string")
    rows = {r["place"]: r["pages"] for r in html_main.site_statistics(df).collect()}
    assert rows == {"": 50, "/div.post.post-#": 50, "/div.post.post-#/p.c#": 50, "/div.post.post-#/p.u-#": 50}
