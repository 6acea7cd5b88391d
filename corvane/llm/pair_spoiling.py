"""Defective pairs made from sound ones, to fit a classifier on."""

from __future__ import annotations

import json
import random
import re
from typing import NamedTuple

from corvane.llm import pair_phrases as P
from corvane.llm.languages import language_of
from corvane.llm.pair_features import looks_like


class Example(NamedTuple):
    """A pair, the place of its defect (-1 for none), the sound pairs it is made of, whether it is one of them as it was."""

    prompt: str
    target: str
    label: int
    made_of: tuple[int, ...]
    original: bool


def _shell(rng: random.Random, inner: str = "") -> str:
    return f'<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 {rng.randint(400, 1900)} {rng.randint(300, 1400)}" width="{rng.randint(400, 1900)}" height="{rng.randint(300, 1400)}">{inner}</svg>'


def _inside(text: str) -> str:
    return text.replace("&", "&amp;").replace('"', "&quot;").replace("<", "&lt;")


def _cut(text: str, rng: random.Random) -> str:
    at = rng.randint(max(1, len(text) // 6), max(2, len(text) - 9))
    return text[:at] + rng.choice(["", "", "", "", "...", "…"])


def _omit(target: str, lang: str, late: bool, rng: random.Random) -> str:
    note = rng.choice(P.part(P.OMISSIONS[lang], late)).format(rng.randint(2, 19))
    note = rng.choice(["", "", "... ", "// "]) + note + rng.choice(["", "", ".", "..."])
    if looks_like(target) == "ir":
        ends = [m.start() for m in re.finditer(r"[{,]\s*\"id\"", target)]
        return target[: rng.choice(ends)] + rng.choice([f"/* {note} */", f"// {note}\n"]) + rng.choice(["", "]}", "}]}"]) if ends else _cut(target, rng)
    pieces = re.split(r"(?=<(?!/)(?!svg|SVG))", target)
    if len(pieces) < 3:
        return _cut(target, rng)
    kept = pieces[: max(2, int(len(pieces) * rng.uniform(0.3, 0.8)))]
    return "".join(kept) + f"<!-- {note} --></svg>"


def _edit(text: str, rng: random.Random) -> str:
    """A copy but for a little."""
    kind = rng.randint(0, 5)
    if kind == 0:
        return text.lower() if rng.random() < 0.5 else text.upper()
    if kind == 1:
        return re.sub(r" ", "  ", text)
    words = text.split(" ")
    if kind == 2:
        return " ".join(w for w in words if rng.random() > 0.06)
    if kind == 3:
        return " ".join(words[: max(6, int(len(words) * rng.uniform(0.8, 1)))])
    return text


def _wrap(text: str, form: str, rng: random.Random) -> str:
    """A text in place of a drawing."""
    if form == "ir":
        quoted = text.replace("\\", "").replace('"', '\\"').replace("\n", " ")
        return rng.choice([text, f'{{"schema_version":"0.1","diagram_type":"process","title":"Figure","nodes":[{{"id":"n1","kind":"box","label":"{quoted}"}}],"edges":[],"groups":[]}}'])
    box = rng.choice(["", "", "", f'<rect x="0" y="0" width="{rng.randint(90, 900)}" height="{rng.randint(40, 700)}" fill="white"/>'])
    label = f'<text x="{rng.randint(1, 90)}" y="{rng.randint(1, 90)}">{_inside(text)}</text>'
    return rng.choice([text, text, f"<!-- {text} -->", _shell(rng, box + label), _shell(rng, box + label), f"```\n{text}\n```"])


def _emptied(target: str) -> str:
    """The document without what it shows."""
    try:
        document = json.loads(target)
    except (ValueError, RecursionError):
        document = None
    if not isinstance(document, dict):
        return "{}"
    return json.dumps(document | {k: [] for k in ("nodes", "edges", "groups") if k in document}, ensure_ascii=False, separators=(",", ":"))


def refusal(lang: str, subject: str, late: bool, rng: random.Random) -> str:
    opening, core, end = (rng.choice(P.part(part, late)) for part in P.REFUSALS[lang])
    about = rng.choice(["{}", '"{}"', "{}"]).format(subject)
    text = f"{opening} {core.format(about)}{end}".strip()
    return text[0].upper() + text[1:]


def _subject(prompt: str, rng: random.Random) -> str:
    words = prompt.split()
    at = rng.randint(0, max(0, len(words) - 8))
    return " ".join(words[at : at + rng.randint(1, 7)]).strip(".,:;")


def _long(prompt: str, rng: random.Random) -> str:
    """The prompt's phrases again and again in another order, over a window long."""
    parts = [p for p in re.split(r"(?<=[.,:;!?])\s+", prompt) if p] or ["-"]
    out, words, most = [], 0, 130 * 8 ** rng.random()
    while words < most:
        out.append(rng.choice(parts))
        words += max(1, len(out[-1].split()))
    return " ".join(out)


def _long_refusal(prompt: str, spoken: str, form: str, late: bool, rng: random.Random) -> str:
    text = f"{_long(prompt, rng)} {refusal(spoken, _subject(prompt, rng), late, rng)}"
    if form == "svg" and rng.random() < 0.5:
        box = "".join(f'<rect x="{rng.randint(1, 90)}" y="{rng.randint(1, 90)}" width="90" height="40"/>' for _ in range(rng.randint(2, 4)))
        return _shell(rng, box + f'<text x="5" y="9">{_inside(text)}</text>')
    return rng.choice([text, _shell(rng, f'<text x="5" y="9">{_inside(text)}</text>')])


def spoiled(base: list[tuple[str, str]], seed: int, late: bool = False, long: float = 0.3) -> list[Example]:
    """Examples made of sound pairs; ``late`` ones use the constructions kept for the thresholds.

    ``long`` is the part of pairs that get a long text before a refusal, and a harmless one.
    """
    rng = random.Random(seed)
    out: list[Example] = []
    by_lang: dict[str, list[int]] = {}
    for k, (prompt, _) in enumerate(base):
        by_lang.setdefault(language_of(prompt), []).append(k)
    for k, (prompt, target) in enumerate(base):
        spoken, form = language_of(prompt), looks_like(target)
        others = [lang for lang in by_lang if lang != spoken]

        def add(prompt: str, target: str, label: int, *also: int, original: bool = False, k: int = k) -> None:
            out.append(Example(prompt, target, label, (k, *also), original))

        add(prompt, target, -1, original=True)
        add(prompt, _omit(target, spoken if rng.random() < 0.7 else rng.choice(list(P.OMISSIONS)), late, rng) if rng.random() < 0.4 else _cut(target, rng), 1)
        if rng.random() < 0.8:
            add(prompt, _wrap(refusal(spoken if rng.random() < 0.7 else rng.choice(list(P.REFUSALS)), _subject(prompt, rng), late, rng), form, rng), 2)
        if rng.random() < 0.5:
            add(prompt, _wrap(rng.choice(P.LEADS) + _edit(prompt, rng), form, rng), 3)
        if rng.random() < 0.3:
            blank = rng.choice([*P.NOTHINGS, _shell(rng, rng.choice(["", "\n", "<g></g>", "<defs/>", "<!-- -->"])), '{"schema_version":"0.1","title":"Figure","nodes":[],"edges":[]}'])
            add(prompt, _emptied(target) if form == "ir" and rng.random() < 0.6 else blank, 0)
        if others and rng.random() < 0.6:
            lang = rng.choice(others)
            other = rng.choice(by_lang[lang])
            add(prompt, base[other][1], 4, other)
            ask = rng.choice(P.LABELS_IN[spoken]).format(P.LANGUAGES_IN[lang][["en", "de", "fr", "es"].index(spoken)])
            other = rng.choice(by_lang[lang])
            add(prompt + " " + ask, base[other][1], -1, other)
            add(prompt + " " + ask, target, 4)
        if rng.random() < 0.4:  # sound answers with something odd in them, and answers to other prompts
            if form == "svg" and "</svg>" in target.lower():
                odd = rng.choice([f"<desc>{_inside(prompt)}</desc>", f"<!-- {rng.choice(P.HARMLESS)} -->", f'<text x="5" y="9">{_inside(rng.choice(P.HARMLESS_LABELS))}</text>'])
                at = target.find(">") + 1
                add(prompt, target[:at] + odd + target[at:], -1)
            other = rng.choice(by_lang[spoken])
            add(prompt, base[other][1], -1, other)
        if rng.random() < 0.08 and form == "svg":  # labels without a shape around them
            texts = re.findall(r"<text\b[^>]*>[^<]*</text>", target)
            if len(texts) > 1:
                add(prompt, _shell(rng, "".join(texts[: rng.randint(2, 12)])), -1)
        if rng.random() < long:
            add(prompt, _long_refusal(prompt, spoken, form, late, rng), 2)
        if rng.random() < long and form == "svg" and "</svg>" in target.lower():
            other = rng.randrange(len(base))
            at = target.find(">") + 1
            add(prompt, target[:at] + f'<text x="5" y="9">{_inside(_long(base[other][0], rng))}</text>' + target[at:], -1, other)
    return out


def built_in(size: int, seed: int = 7) -> list[tuple[str, str]]:
    """Sound pairs for tables that hold too few of their own."""
    rng, out = random.Random(seed), []
    for k in range(size):
        lang = sorted(P.THINGS)[k % 4]
        chosen = rng.choices(P.THINGS[lang].split(), k=7)
        if k % 3:
            parts = "".join(f'<rect x="{rng.randint(1, 900)}" y="{rng.randint(1, 900)}" width="80" height="40"/><text x="{rng.randint(1, 900)}" y="9">{w}</text>' for w in chosen)
            target = _shell(rng, parts)
        else:
            nodes = ",".join(f'{{"id":"n{n}","kind":"box","label":"{w}"}}' for n, w in enumerate(chosen))
            target = f'{{"schema_version":"0.1","diagram_type":"process","title":"{chosen[0]}","nodes":[{nodes}],"edges":[],"groups":[]}}'
        out.append((P.ASKS[lang].format(*chosen[:3], ", ".join(chosen)), target))
    return out
