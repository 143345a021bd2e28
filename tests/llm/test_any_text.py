"""Very long runs and broken markup: no crash, linear time, same results."""

from __future__ import annotations

import random
import time

import pytest

from tsengine.llm import html_text, token_counts


def test_long_runs_encode_as_short_ones_do(monkeypatch):
    encoding, _ = token_counts.encoder(token_counts.VOCABULARY)
    rnd = random.Random(4)
    parts = [" ", "  ", "\n", "\n\n \t", "  ", "word", "Ünï", "12", "!?", " x", "'s", "\x1c\x1f", "　" * 3, "\r\n" * 4]
    texts = ["".join(rnd.choices(parts, k=rnd.randrange(30))) for _ in range(600)] + ["", "   ", "\n\n\nx", "x \n"]
    want = encoding.encode_ordinary_batch(texts)
    for least in (2, 3, 7):
        monkeypatch.setattr(token_counts, "LONG_RUN", least)
        assert token_counts.encode_whole(encoding, texts) == want


@pytest.mark.parametrize("text", [" " * 10_000_000, "\n" * 3_000_000 + "end", "a" * 10_000_000, "x" + " \n" * 1_500_000 + "y"])
def test_ten_million_characters_in_one_run(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = token_counts.count_tokens(docs).selectExpr("n_tokens", "n_bytes", "aggregate(sections, 0D, (a, s) -> a + s.tokens) as t").first()
    assert row["n_bytes"] == len(text) and 0 < row["n_tokens"] == round(row["t"])


@pytest.mark.parametrize("piece", ["<a ", "<!--", "<div>", "</x>", "<", "</", "<!", "<?x ", "<p>", "<b>", "<div></x>", "<a b='", "&", "<![CDATA["])
def test_a_megabyte_of_broken_markup_takes_linear_time(piece):
    start = time.process_time()
    for html in (piece * (1_000_000 // len(piece)), "<p>text</p>" + piece * (300_000 // len(piece)) + "<p>more text</p>"):
        html_text.main_text(html)
    assert time.process_time() - start < 20


def test_cut_off_markup_is_no_text():
    for tail in ("<div cla", "<!-- never closed <p>x</p>", "<a href='x", "</p", "<!doc", "<a <a <a "):
        assert html_text.main_text("<article><p>Kept words, all of them.</p>" + tail) == "Kept words, all of them."
    assert html_text.main_text("<p>a <!-- x --> b</p><!-- y") == "a b"
    assert html_text.main_text("<p>1 < 2 and 3 > 2</p>") == "1 < 2 and 3 > 2"
    assert html_text.main_text("<p>1 < 2") == "1 < 2"
    assert html_text.whole_markup("a<!-->b") == "a" and html_text.whole_markup("a<!--b-->c") == "a<!--b-->c"


def test_end_tags_close_what_they_open():
    page = "<div><div class='menu'><b>no<p>no</div></x></section><p>Yes, this.</p></div><p>Tail"
    assert "Yes, this." in html_text.main_text(page) and "no" not in html_text.main_text(page).split()
