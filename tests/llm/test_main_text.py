"""Hints that density speaks against, and text beside the marked article."""

import pytest

from adtally.llm import html

LONG, SHORT, OTHER = "A text of some words. " * 20, "Some more words here. " * 8, "Words of another kind now. " * 30
P = [f"<p>{x}</p>" for x in (LONG, SHORT, OTHER)]
WIDGET = "<div class='elementor-widget elementor-widget-text-editor'>{}</div>"

KEPT = {
    "widget": (f"<article>{WIDGET.format(P[0])}</article>", LONG),
    "widgets": (f"<article>{WIDGET.format('<h2>Head</h2>')}{''.join(map(WIDGET.format, P * 3))}</article>", "Head " + (LONG + SHORT + OTHER) * 3),
    "half widget": (f"<article>{P[0]}{WIDGET.format(P[1])}{P[2]}</article>", LONG + SHORT + OTHER),
    "form": (f"<body><form id=aspnetForm><input><div>{P[0]}{P[1]}</div></form></body>", LONG + SHORT),
    "form around": (f"<body><form><div class=sidebar><p>side</div><div>{P[0]}{P[1]}</div></form><div class=ad>Buy it.</div>", LONG + SHORT),
    "social": (f"<div class='social-policy'>{P[0] * 4}</div><div class=social><a href=x>Follow us there</a></div>", LONG * 4),
    "sibling": (f"<body><div><article>{P[0] * 9}</article><article>{P[1]}</article></div></body>", LONG * 9 + SHORT),
    "deep sibling": (f"<body><article>{P[0] * 9}</article><div><i><article>{P[1]}</article></i><a href=x>more</a></div></body>", LONG * 9 + SHORT),
    "dense sibling": (f"<body><article>{P[1] * 9}</article><section>{P[2] * 9}</section></body>", SHORT * 9 + OTHER * 9),
    "widget siblings": (
        f"<div class=widget><article>{P[0] * 9}</article></div><div class=widget><article>{P[1]}</article></div>", LONG * 9 + SHORT
    ),
    "only comments": (f"<div class=comments>{P[0]}{P[1]}</div>", LONG + SHORT),
}
GONE = {
    "share": f"<article>{P[0] * 2}<div class=share>Share it: <a href=x>there</a> <a href=y>and there</a></div></article>",
    "ad": f"<article>{P[0] * 2}<div class=ad>Buy this thing now, it is cheap and good.</div></article>",
    "comments": f"<div>{P[0]}{P[0]}</div><div class=comments>{P[2] * 9}</div>",
    "login": f"<article>{P[0] * 2}<form class=login>Name<input>Password<input></form></article>",
    "related": f"<article>{P[0] * 2}</article><div class=related><article><a href=x>Another one</a> teased</article></div>",
    "beside": f"<article>{P[0] * 2}</article><div>Some words</div>",
}


@pytest.mark.parametrize("name", KEPT)
def test_text_is_kept(name):
    page, text = KEPT[name]
    assert html.main_text(page) == " ".join(text.split())


@pytest.mark.parametrize("name", GONE)
def test_noise_goes(name):
    assert html.main_text(GONE[name]) == " ".join((LONG * 2).split())
