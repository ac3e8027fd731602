import random

from orderloom.llm import overlap, simhash


def pair(rnd, size, shared):
    """Two texts of ``size`` distinct shingles each, of which they share the first ``shared``."""
    word = lambda: f"w{rnd.randrange(10**9)}"
    first = [word() for _ in range(size + 4)]
    return " ".join(first), " ".join(first[: shared + 4] + [word() for _ in range(size - shared)])


def test_pairs_at_the_bar_are_linked_and_pairs_below_are_not(documents):
    rnd, rows = random.Random(6), []
    for k in range(150):
        at, below = pair(rnd, 270, 240), pair(rnd, 270, 239)
        rows += [(10 * k, at[0]), (10 * k + 1, at[1]), (10 * k + 2, below[0]), (10 * k + 3, below[1])]
    texts = dict(rows)
    assert overlap.agree(*(overlap.shingles(texts[k]) for k in (0, 1)))
    assert not overlap.agree(*(overlap.shingles(texts[k]) for k in (2, 3)))
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(documents(*rows), wide=True).collect()}
    assert all(found[k + 2] == k + 2 and found[k + 3] == k + 3 for k in range(0, 1500, 10))
    assert sum(found[k + 1] == k for k in range(0, 1500, 10)) >= 149


def test_crowded_bands_equal_brute_force(documents):
    rnd = random.Random(9)
    rows, template = [], [f"t{rnd.randrange(10**9)}" for _ in range(150)]
    for k in range(70):
        words = list(template)
        for at in rnd.sample(range(150), rnd.randint(1, 9)):
            words[at] = f"x{rnd.randrange(10**9)}"
        rows.append((k, " ".join(words)))
    rows += [(100, "a b"), (101, "A  b"), (102, None), (103, ""), (104, rows[3][1])]
    sets, label = {k: overlap.shingles(t or "") for k, t in rows}, {k: k for k, _ in rows}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if label[b] > label[a] and overlap.agree(sets[a], sets[b]):
                    label[b], changed = label[a], True
    assert len(set(label.values())) > 5
    for block in (overlap.BLOCK, 7):
        found = {r.doc_id: r.component_id for r in overlap.near_copies(documents(*rows), block=block).collect()}
        assert found == label


def test_no_rows(documents):
    assert overlap.near_copies(documents()).count() == 0


def test_a_crowded_group_below_the_bar_leaves_no_pairs(documents, monkeypatch):
    rnd = random.Random(4)
    template, rows = [f"t{k}" for k in range(200)], []
    for k in range(120):
        words = list(template)
        for at in range(3 + k % 9, 200, 29):  # all pairs agree by about a half to four fifths
            words[at] = f"x{rnd.randrange(10**9)}"
        rows.append((k, " ".join(words)))
    rows += [(200, rows[5][1] + " end"), (201, rows[5][1] + " other end")]
    written, materialize = {}, overlap.materialize

    def seen(df, label):
        out = materialize(df, label)
        written[label] = out.count()
        return out

    monkeypatch.setattr(overlap, "materialize", seen)
    found = {r.doc_id: r.component_id for r in overlap.near_copies(documents(*rows)).collect()}
    assert found[200] == found[201] == 5 and len(set(found.values())) > 60
    # A pair for every two texts would be some 7,000; without bands a row has at most 24.
    assert max(n for label, n in written.items() if label != "band-members") < 10 * len(rows)
