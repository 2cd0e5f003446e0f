"""Boilerplate of small sites."""

from kindred.llm import line_frequency

PAGES = "doc_id long, text string, source string"


def test_menu_of_a_small_site_goes(spark):
    """Six pages with a line on each, and one line on two pages."""
    rows = [(i, f"Menu\ntext {i}\n{'twice' if i < 2 else i}", "small") for i in range(6)]
    done = line_frequency.drop_boilerplate(spark.createDataFrame(rows, PAGES), "source").collect()
    assert {r._doc.doc_id: r.clean_text for r in done} == {i: t.removeprefix("Menu\n") for i, t, _ in rows}
    kept = line_frequency.stage(spark.createDataFrame(rows, PAGES)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(i, t.removeprefix("Menu\n")) for i, t, _ in rows]


def test_copies_keep_their_text_in_the_stage(spark):
    """Twelve copies of one text among thirty pages, and a menu on all."""
    rows = [(i, "Menu\ncopied text\nof two lines" if i < 12 else f"Menu\ntext {i}", "s") for i in range(30)] + [(30, None, "s")]
    kept = {r.doc_id: r.text for r in line_frequency.stage(spark.createDataFrame(rows, PAGES)).collect()}
    assert kept == {i: t and t.removeprefix("Menu\n") for i, t, _ in rows}
