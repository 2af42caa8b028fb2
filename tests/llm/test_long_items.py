import numpy as np
import pytest

from riskloom.llm import decontaminate


def some_words(rng, n):
    return [f"w{x}" for x in rng.integers(0, 5_000, n)]


def edited(words, rng, kind, n):
    out = list(words)
    for _ in range(n):
        way = rng.integers(3) if kind == "mixed" else ("left out", "inserted").index(kind)
        place = int(rng.integers(len(out)))
        if way == 0:
            del out[place]
        elif way == 1:
            out.insert(place, f"new{rng.integers(1 << 40)}")
        else:
            out[place] = f"new{rng.integers(1 << 40)}"
    return out


@pytest.mark.parametrize("kind", ["left out", "inserted", "mixed"])
@pytest.mark.parametrize("size", [40, 63, 64, 127, 200, 500, 1_000])
def test_items_of_every_size_are_found_at_all_their_edits(size, kind):
    rng, n = np.random.default_rng(size), 4_000 // size
    items = [some_words(rng, size) for _ in range(n)]
    texts = [
        some_words(rng, 20) + edited(w, rng, kind, decontaminate.allowed(size)) + some_words(rng, 20) for w in items
    ]
    known = decontaminate.Items([(i, " ".join(w)) for i, w in enumerate(items)])
    found = known.search([" ".join(t) for t in texts])
    met = sum(any(f["item_id"] == i and f["distance"] <= decontaminate.allowed(size) for f in fs) for i, fs in enumerate(found))
    assert met >= decontaminate.RECALL * n


def test_pieces_cover_an_item_and_share_its_edits():
    for n in range(1, 3_000):
        cut = decontaminate.pieces(n)
        assert cut[0][0] == 0 and cut[-1][1] == n and all(a[1] == b[0] for a, b in zip(cut, cut[1:], strict=False))
        assert all(b - a < 2 * decontaminate.PIECE for a, b in cut)
        assert decontaminate.share(n) * len(cut) <= decontaminate.allowed(n) < (decontaminate.share(n) + 1) * len(cut)
