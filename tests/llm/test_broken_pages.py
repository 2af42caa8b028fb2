"""Pages with broken markup give their text, and large ones take time in proportion."""

import time

import pytest

from riskloom.llm import html_extract

PARAGRAPH = "<p>A paragraph that has quite a few words in it, so that it reads as content, as it should.</p>"


@pytest.mark.parametrize("broken", ["<![]]>", "<![ x>", "<![x", "<!", "<!->", "<!-- open", "<?", "</", "<", "&#xFFFFFFFFFF;", "<![if !x]>", "<!DOCTYPE", "</section></section>"])
def test_broken_markup_costs_no_text(broken):
    found = html_extract.main_text(f"<article>{PARAGRAPH}{broken}</article>")
    assert found.startswith("A paragraph that has")
    assert html_extract.main_text(broken).count("paragraph") == 0


def test_text_behind_a_nameless_declaration_is_read():
    found = html_extract.main_text(f"<article>{PARAGRAPH}<![]]>{PARAGRAPH.replace('A ', 'Another ')}</article>")
    assert found.count("\n") == 1 and "Another paragraph" in found


@pytest.mark.parametrize(
    "page",
    [
        lambda n: "<body>" + "".join(f"<ul><li><a href=x>menu {i}</a></li></ul>{PARAGRAPH}" for i in range(n)),
        lambda n: "<div>text one" * n,
        lambda n: "<b>text one" * n + "</section>" * n,
        lambda n: "<p>a b c</p><div><a>" * n,
    ],
)
def test_time_follows_a_page_s_size(page):
    html_extract.main_text(page(200))
    start = time.perf_counter()
    html_extract.main_text(page(8000))
    assert time.perf_counter() - start < 8


def test_the_cut_is_a_minimum_one():
    import itertools
    import random

    rng = random.Random(4)
    for _ in range(200):
        n = rng.randint(1, 8)
        terminal = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a in range(n) for b in range(a) if rng.random() < 0.4]

        def cost(side):
            cut = sum(c for c, s in zip(terminal, side) if c > 0 and not s) + sum(-c for c, s in zip(terminal, side) if c < 0 and s)
            return cut + sum(w for a, b, w in edges if side[a] != side[b])

        best = min(cost(side) for side in itertools.product([False, True], repeat=n))
        assert abs(cost(html_extract.minimum_cut(terminal, edges)) - best) < 1e-9
