"""What the page reader takes for text around scripts, controls and players."""

import time

import pytest

from skyspark.llm.html_extract import Page

ONE, TWO, THREE = "The first paragraph.", "The second paragraph.", "The third paragraph."


def everything(source):
    page = Page(source)
    import numpy as np

    return page.text(np.ones(len(page.parent), bool)).split("\n\n")


@pytest.mark.parametrize("tag", ["button", "svg", "object", "select", "canvas", "video", "audio", "button class=x/", "object data=/a/"])
@pytest.mark.parametrize("end", ["", "</p>", "</article>"])
def test_an_element_left_open_takes_no_paragraph(tag, end):
    inside = f"<p>{ONE} <{tag}>gone{end}" if end == "</p>" else f"<p>{ONE}</p><{tag}>gone"
    assert everything(f"<article>{inside}<p>{TWO}</p><p>{THREE}</p>{'' if end == '</article>' else '</article>'}") == [ONE, TWO, THREE]


@pytest.mark.parametrize("tag", ["button", "svg", "object", "select", "canvas", "video", "audio"])
def test_a_closed_element_is_dropped_with_its_markup(tag):
    assert everything(f"<p>{ONE} <{tag} a='b'><div>no <b>text</b></div></{tag.upper()} > {TWO}</p><p>{THREE}</p>") == [f"{ONE} {TWO}", THREE]


def test_of_two_of_a_kind_only_the_one_that_ends_is_dropped_whole():
    assert everything(f"<p>{ONE}</p><button>open<p>{TWO}</p><button><p>closed</p></button><p>{THREE}</p>") == [ONE, TWO, THREE]


@pytest.mark.parametrize("tag", ["<script src=/js/>", "<script src='a.js'/>", "<style media=all/>", "<style/>", "<script>", "<textarea/>", "<iframe src=/x/>", "<template a=/>"])
def test_a_slash_does_not_end_a_script(tag):
    name = tag[1:].split()[0].rstrip("/>")
    assert everything(f"<article><p>{ONE}</p>{tag}var x = '<p>no</p>' </{name}><p>{TWO}</p></article>") == [ONE, TWO]


def test_a_drawing_may_end_itself():
    assert everything(f"<p>{ONE} <svg width=1 /> {TWO}</p>") == [f"{ONE} {TWO}"]


@pytest.mark.parametrize("tag", ["noscript", "math"])
def test_these_are_text(tag):
    assert everything(f"<article><p>{ONE} <{tag}>x = 1</{tag}></p><p>{TWO}</p></article>") == [f"{ONE} x = 1", TWO]


@pytest.mark.parametrize("source", ["<button>" * 300_000, "<svg><object>" * 150_000 + "</svg>" * 100_000, "<video><p>x" * 100_000])
def test_many_of_them_take_seconds(source):
    began = time.perf_counter()
    Page(source)
    assert time.perf_counter() - began < 20
