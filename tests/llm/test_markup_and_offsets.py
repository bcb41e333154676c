"""Tags by HTML's own rules, and offsets in the text's own code points."""

import time

import pytest

from pumpguard.llm import decontaminate, html_extract


def texts(page):
    return [t for _, t, _ in html_extract.Page(page).pieces]


@pytest.mark.parametrize("page,want", [
    ("<article><p title=it's>First one.</p><p>Second isn't lost.</p></article>", ["First one.", "Second isn't lost."]),
    ("<p title=it's>Only one.</p>", ["Only one."]),
    ("<p don't>Name with a quote.</p><p>Next, isn't it?</p>", ["Name with a quote.", "Next, isn't it?"]),
    ("<p title='a > b' class=\"x > y\">Quoted signs.</p>", ["Quoted signs."]),
    ("<p title = 'a > b'>Spaces around.</p>", ["Spaces around."]),
    ("<p title=\"never closed>Still text.</p><p>More.</p>", ["Still text.", "More."]),
    ("<p a==b c=>Odd signs.</p>", ["Odd signs."]),
    ("<script src=//x.com/a/>var secret=1;</script><p>Text.</p>", ["Text."]),
    ("<script/>var secret=1;</script><p>Text.</p>", ["Text."]),
    ("<style />p {color: red}</style><p>Text.</p>", ["Text."]),
    ("<p>Before<svg/>after.</p>", ["Beforeafter."]),
    ("<p>Before <svg><text>drawn</text></svg>after.</p>", ["Before after."]),
    ("<p>Open tag at the end <b class='x", ["Open tag at the end"]),
])
def test_tags_are_read_as_html_reads_them(page, want):
    assert texts(page) == want


def test_long_odd_tags_take_linear_time():
    for tag in ("<p " + "a=" * 200_000, "<p " + "\"'" * 200_000, "<p " + "x " * 200_000 + "=", "<" + "p/" * 200_000):
        begun = time.perf_counter()
        html_extract.Page(tag + ">text")
        assert time.perf_counter() - begun < 5


def test_names_are_read_without_their_quotes():
    page = html_extract.Page("<div class='sidebar'><p>a</p></div><div class=sidebar><p>b</p></div><div id=\"x\"><p>c</p></div>")
    assert [page.names[i] for i, t in enumerate(page.tags) if t == "div"] == [-1, -1, 0]


def test_offsets_are_code_points_of_the_text(spark):
    item = "seven quick wizards boxed eleven jolly foxes behind twelve quiet mills"
    text = "İ" * 10 + " İİ. " + item.upper() + " the end İ"
    docs = spark.createDataFrame([(1, text), (2, "plain " + item), (3, "nothing here")], "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r["doc_id"]: (r["start"], r["stop"]) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {1: (text.index("SEVEN"), text.index(" the end")), 2: (6, 6 + len(item))}
    assert decontaminate.spots_of("Aİ b") == [(0, 2), (3, 4)]
