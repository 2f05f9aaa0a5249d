import random
import re

import pytest

from tidemark.llm import license_scan as L

MIT = next(t for l, t in L.NOTICES if l == "mit")
GPL = next(t for l, t in L.NOTICES if l == "gpl")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def base_of(text):
    w, found = words(text), []
    for label, phrase in L.PHRASES:
        p = phrase.split()
        found += [(i, label) for i in range(len(w)) if w[i:i + len(p)] == p]
    starts = [i for i, _ in found]
    return (len(w), len(found), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({l for _, l in found})))


def check_base(df, rows):
    found = df.collect()
    want = sorted((str(i), *map(str, base_of(t))) for i, t in rows)
    assert sorted((str(r.doc_id), *map(str, (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)))
                  for r in found) == want
    for r in found:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "")
    return {r.doc_id: r for r in found}


def naive_fits(text, template, edits):
    """Ends at which the template is within its edits of some stretch of the text."""
    cost = [[0] * (len(text) + 1)]
    for i, w in enumerate(template, 1):
        row = [i]
        for j, x in enumerate(text, 1):
            row.append(min(cost[-1][j - 1] + (x != w), cost[-1][j] + 1, row[-1] + 1))
        cost.append(row)
    return {j: c for j, c in enumerate(cost[-1]) if c <= edits}


def edited(text, share, rng):
    w = words(text)
    for i in rng.sample(range(len(w)), int(len(w) * share)):
        kind = rng.randrange(3)
        w[i] = "" if kind == 0 else "changed" if kind == 1 else w[i] + " inserted"
    return " ".join(w)


def test_places_of_phrases_in_the_whole_table(documents):
    check_base(L.license_report(documents), [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()])


def test_odd_rows(odd, odd_rows):
    check_base(L.license_report(odd), odd_rows)


def test_cases_and_separators(spark):
    rows = [(1, "MIT-License; mit\nlicense, MITLicense"), (2, "CC-BY cc by CC\x7fBY éCC BY CCé BY"),
            (3, "gnu General\0Public!License apache  LICENSE" * 3), (4, "mit license " * 5000), (5, "license mit"), (6, "cc")]
    found = check_base(L.license_report(spark.createDataFrame(rows, "doc_id long, text string")), rows)
    assert found[4].n_base == 5000 and found[4].last_word == 9998


def test_notices_with_edits(spark):
    rng = random.Random(3)
    filler = [f"w{i}" for i in range(400)]
    pad = lambda: " ".join(rng.choices(filler, k=rng.randrange(300)))
    rows, want = [], {}
    for i in range(30):
        rows.append((i, f"{pad()} {edited(MIT if i % 2 else GPL, 0.15, rng)} {pad()}"))
        want[i] = "mit" if i % 2 else "gpl"
    rows.append((100, pad() + " " + edited(MIT, 0.9, rng)))
    rows.append((101, " ".join(words(MIT)[:20]) + " " + pad()))
    heads, spans = L.license_spans(spark.createDataFrame(rows, "doc_id long, text string"))
    names = {r.row: r.doc_id for r in heads.collect()}
    found = {}
    for s in spans.where("not base").collect():
        found.setdefault(names[s.row], []).append(s)
    for i, label in want.items():
        assert label in [s.label for s in found[i]]
    assert not set(found) & {100, 101}
    texts = dict(rows)
    for i, spans_ in found.items():
        for s in spans_:
            stretch = words(texts[i])[s.first:s.last + 1]
            ok = [t for t in L.templates_of([], L.NOTICES) if t.label == s.label]
            assert any(len(stretch) in naive_fits(stretch, t.words, t.edits) for t in ok)


def test_every_place_within_the_edits_is_voted_for():
    """The least number of votes is met by any edits, also by those that spoil most k-grams."""
    for t in L.templates_of([], L.NOTICES):
        text = list(t.words)
        for i in range(t.edits):
            text[(i * t.gram + t.gram - 1) % len(text)] = "?"
        grams = lambda w: {tuple(w[i:i + t.gram]) for i in range(len(w) - t.gram + 1)}
        shared = sum(tuple(text[i:i + t.gram]) in grams(list(t.words)) for i in range(len(text) - t.gram + 1))
        assert shared >= t.votes


@pytest.mark.parametrize("seed", range(6))
def test_fits_against_brute_force(seed):
    rng = random.Random(seed)
    t = L.Template("x", tuple(rng.choices("abcdefgh", k=24)), False)
    text = rng.choices("abcdefgh", k=40) + [w for w in t.words if rng.random() > 0.1] + rng.choices("abcdefgh", k=40)
    naive = naive_fits(text, t.words, t.edits)
    found = L.fits(text, 0, len(text), t)
    assert bool(found) == bool(naive)
    for a, b, s in found:
        assert len(text[a:b + 1]) in naive_fits(text[a:b + 1], t.words, t.edits)
        assert round((1 - s) * len(t.words)) == naive[b + 1]
    if naive:
        assert max(s for _, _, s in found) == 1 - min(naive.values()) / len(t.words)


def test_the_more_similar_notice_wins(spark):
    rows = [(1, "under the GNU Lesser General Public License"), (2, "Licensed under CC BY-NC 4.0."),
            (3, "GNU General Public License, version 3."), (4, GPL.replace("GNU General", "GNU Affero General"))]
    found = {r.doc_id: r for r in L.license_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (found[1].labels, found[1].base_labels) == ("lgpl", "")
    assert (found[2].labels, found[2].base_labels) == ("cc-by,cc-by-nc", "cc-by")
    assert found[3].labels == "gpl,gpl-3.0"
    assert (found[4].labels, found[4].n_base) == ("agpl", 0)


def test_no_rows_no_templates_many_regions(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert L.license_report(none).count() == 0
    docs = spark.createDataFrame([(1, "mit license"), (2, None)], "doc_id long, text string")
    assert [r.n_base for r in L.license_report(docs, [], []).collect()] == [0, 0]
    far = ("mit license " + "w " * 700) * 40
    check_base(L.license_report(spark.createDataFrame([(1, far)], "doc_id long, text string")), [(1, far)])
