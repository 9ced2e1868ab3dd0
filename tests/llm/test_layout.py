"""Rules of visibility, list numbers and blocks, against small examples and a plain computation."""

import random

import pytest

from skumill.llm.html_text import extracted, numeral, page_text


@pytest.mark.parametrize(
    "page, want",
    [
        ("<p>a<div>b</p>c", "a\n\nb\n\nc"),
        ("<p>a<p>b</p>c</p>d<p>e<ul><li>f</ul></p>g", "a\n\nb\n\ncd\n\ne\n\n- f\n\ng"),
        ("<dialog>no</dialog><dialog open>yes</dialog>", "yes"),
        ("<style>.m .n{display:none} .k > b{display:none} p#i.c{display:none}</style><div class=m><i><b class=n>1</b></i>2</div><b class=n>3</b><div class=k><b>4</b><i><b>5</b></i></div><p id=i class='c d'>6</p><p id=i>7</p>", "2\n3\n5\n\n7"),
        ("<style>div.a i{display:none} .b i{display:inline}</style><div class=a><i>1</i></div><div class='a b'><i>2</i></div>", ""),
        ("<style>.a > .b .c > i{display:none}</style><div class=a><p class=b><u class=b><b class=c><i>1</i></b></u></p></div>z", "z"),
        ("<style>a:hover{display:none} [x]{display:none} *{visibility:visible}</style><a x=1>shown</a>", "shown"),
        ("<ol><li value=5>a<li>b</ol><ol reversed><li>x<li>y<li value=9>z<li>w</ol>", "5. a\n6. b\n\n4. x\n3. y\n9. z\n8. w"),
        ("<ol type=a start=26><li>a<li>b<li type=I>c</ol><ol type=i><li value=4>d<li value=-1>e</ol>", "z. a\naa. b\nXXVIII. c\n\niv. d\n-1. e"),
        ("<input type=checkbox value=no><input type=RESET value=q><object data=x>instead <b>text</b></object>", "qinstead text"),
    ],
)
def test_rules(page, want):
    assert page_text(page) == want


def test_numerals():
    roman = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}
    for n in range(1, 4000):
        values = [roman[c] for c in numeral(n, "i")]
        assert sum(-a if a < b else a for a, b in zip(values, [*values[1:], 0], strict=True)) == n
    letters = [numeral(n, "A") for n in range(1, 800)]
    assert letters[:3] == ["A", "B", "C"] and letters == sorted(letters, key=lambda x: (len(x), x)) and len(set(letters)) == 799
    assert [numeral(n, "a") for n in (0, -3)] == ["0", "-3"] and numeral(5000, "I") == "5000"


def _nested(rng, depth):
    """HTML of nested blocks and lists, and the lines (blank before, text) that they have to give."""
    html, lines = [], []
    for _ in range(rng.randrange(1, 4)):
        kind = rng.choice(["text", "div", "p", "list"] if depth else ["text", "div", "p"])
        word = f"w{rng.randrange(1000)}"
        if kind == "text":
            html.append(f"<section>{word}</section>")
            lines.append((False, word, False))
        elif kind == "div":
            html.append(f"<div>{word}<br>{word}b</div>")
            lines += [(False, word, False), (False, word + "b", False)]
        elif kind == "p":
            html.append(f"<p>{word}" + rng.choice(["</p>", ""]))
            html.append("" if html[-1].endswith("</p>") else "</p>")
            lines.append((True, word, True))
        else:
            own, n = [], rng.randrange(1, 4)
            ordered = rng.random() < 0.5
            for k in range(n):
                inner, got = _items(rng, depth - 1)
                mark = f"{k + 1}. " if ordered else "- "
                own.append(f"<li>{inner}" + rng.choice(["", "</li>"]))
                lines += [(k == 0 and not i, (mark if not i else " " * len(mark)) + t, k == n - 1 and i == len(got) - 1) for i, t in enumerate(got)]
            tag = "ol" if ordered else "ul"
            html.append(f"<{tag}>{''.join(own)}</{tag}>")
    return "".join(html), lines


def _items(rng, depth):
    """A list item's content: a word, and perhaps a list inside."""
    word = f"i{rng.randrange(1000)}"
    if depth <= 0 or rng.random() < 0.5:
        return word, [word]
    own, lines = [], [word]
    for _ in range(rng.randrange(1, 3)):
        inner, got = _items(rng, depth - 1)
        own.append(f"<li>{inner}</li>")
        lines += [("- " if not i else "  ") + t for i, t in enumerate(got)]
    return f"{word}<ul>{''.join(own)}</ul>", lines


def test_blocks_and_lists_against_a_plain_layout():
    rng = random.Random(12)
    for _ in range(300):
        page, lines = _nested(rng, 3)
        want, after = [], False
        for before, text, behind in lines:
            if want and (before or after):
                want.append("")
            want.append(text)
            after = behind
        assert page_text(page) == "\n".join(want), page


def test_repeated_rows_and_clashing_names(spark):
    rows = [(1, "u", "<p>a"), (1, "u", "<p>a"), (None, None, None), (2, "u", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "'x' AS __text", "2 AS title", "3 AS n_lines")
    got = sorted(((r.page_id, r.text, r.n_lines) for r in extracted(df).collect()), key=repr)
    assert got == sorted([(1, "a", 1), (1, "a", 1), (None, "", 0), (2, "", 0)], key=repr)
