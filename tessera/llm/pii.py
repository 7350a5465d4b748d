"""Personal data: fixed base rules, and a boosted-tree verdict on further candidate spans.

Generators with high recall propose overlapping spans (written-out e-mail addresses, national phone numbers of two
groups or more or in one run, dates excepted, card numbers with odd separators or of 13 to 19 digits, version-6 addresses whole or compressed); boosted trees score each by its format and its context; a span
is taken where the score passes its threshold, set to a precision of at least PRECISION on other such spans and on
spans that other templates than those of training put into other sentences. No table marks spans, so both kinds are composed here. Base spans always stay;
of overlapping further spans the more probable stays, and none may overlap a base span.

Defined results: null text is empty and has no spans; repeated rows give the same; spans count code points.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left, insort
from functools import cache
from ipaddress import IPv6Address

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.boosting import Boosted
from tessera.llm.common import DOCUMENT, made, pick, ship, small_batches, table

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.995
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Candidate patterns.
_WRITTEN = re.compile(r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+ ?(?:\[at\]|\(at\)|\{at\}|(?<= )at(?= )) ?[a-z0-9-]{1,63}(?: ?(?:\[dot\]|\(dot\)|\{dot\}|(?<= )dot(?= )|\.) ?[a-z0-9-]{1,63}){1,6}")
_WRITTEN_GATE = re.compile(r"(?i)[\[({]at[\])}]| at ")
# A number's parts, apart by a sign, blanks, or a sign between blanks; a part in brackets needs neither.
_GAP = r"(?: [./-] |[ ./-]{1,2})"
_NATIONAL = re.compile(rf"(?<![\w+.-])(?:\([0-9]{{2,5}}\)|00[0-9]{{1,3}}|[0-9]{{1,5}})(?:(?:{_GAP})?\([0-9]{{1,4}}\)(?:{_GAP})?[0-9]{{2,8}}|{_GAP}[0-9]{{2,8}}){{1,5}}(?![\w-])")
_BARE = re.compile(r"(?<![\w+.,-])[0-9]{9,12}(?![\w-]|[.,][0-9])")
_DATE = re.compile(r"(?:(?:19|20)[0-9]{2}([ ./-])(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12][0-9]|3[01])|(?:0?[1-9]|[12][0-9]|3[01])([ ./-])(?:0?[1-9]|1[0-2])\2(?:19|20)[0-9]{2}|(?:0?[1-9]|1[0-2])([ ./-])(?:0?[1-9]|[12][0-9]|3[01])\3(?:19|20)[0-9]{2})")
_SHORT_CARD = re.compile(r"(?<![\w.-])[0-9](?:[ -]?[0-9]){12,18}(?![\w-])")
_ODD_CARD = re.compile(r"(?<![\w.-])[0-9]{4}(?:[ ._/-]{1,2}[0-9]{4}){3}(?![\w])")
_SIX = re.compile(r"(?:(?<![\w:])|(?<=[^\W0-9A-Fa-f_]:))[0-9A-Fa-f]{0,4}+(?::[0-9A-Fa-f]{0,4}+){2,8}(?![\w:]|\.[0-9])")
_SIX_GATE = re.compile(r":[0-9A-Fa-f]{0,4}:")
_TELL = (
    ("email", re.compile(r"(?i)mail|contact|write|reach|correo|courriel|kontakt")),
    ("phone", re.compile(r"(?i)phone|\btel|\bcall|mobile|fax|\bcell|\bruf|anruf|erreich|handy|telefon|teléfono|llám|llam|móvil|\bappel|portable|joindre|whatsapp|\bdial|büro|\boffice|\bnumber(?: is|:)|nummer(?: ist|:)|numéro(?: est| :|:)|número(?: es|:)|\bring\b|\btext me|\bsms")),
    ("card", re.compile(r"(?i)card|visa|master|credit|debit|karte|tarjeta|carte|payment|paid")),
    ("ip", re.compile(r"(?i)\bip\b|address|host|server|login|adresse|direcci")),
    ("other", re.compile(r"(?i)order|invoice|version|isbn|date|ref|serial|no\.|number of|score|price|total|page|id\b|\$|€")),
)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """What a leftmost search finds, in time linear in the text: each match has one @, and starts where the run of
    characters before it starts, or where the match before it ended."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            out.append((start, end))
        at = text.find("@", max(end, at + 1))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGIT.findall(m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Spans that may be personal data beyond the base ones; they may overlap."""
    out = []
    if _WRITTEN_GATE.search(text):
        for m in _WRITTEN.finditer(text):
            out.append(("email", *m.span()))
            # Where a sentence may end inside it, what is before that end is proposed as well.
            stop = m.start() + m[0].find(". ")
            if stop > m.start() and _WRITTEN.fullmatch(text, m.start(), stop):
                out.append(("email", m.start(), stop))
    if _DIGIT.search(text):
        out += [("phone", *m.span()) for p in (_NATIONAL, _BARE) for m in p.finditer(text) if 6 <= len(_DIGIT.findall(m[0])) <= 15 and not _DATE.fullmatch(m[0])]
        out += [("card", *m.span()) for p in (_ODD_CARD, _SHORT_CARD) for m in p.finditer(text)]
    if ":" in text and _SIX_GATE.search(text):
        out += sixes(text)
    return out


def sixes(text: str) -> list[tuple[str, int, int]]:
    """Version-6 addresses, whole or compressed; a colon after one isn't part of it."""
    out = []
    for m in _SIX.finditer(text):
        start, end = m.span()
        if text[end - 1] == ":" != text[end - 2]:
            end -= 1
        try:
            IPv6Address(text[start:end])
        except ValueError:
            continue
        out.append(("ip", start, end))
    return out


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    span, before, after = text[start:end], text[max(0, start - 40) : start], text[end : end + 20]
    digits = "".join(_DIGIT.findall(span))
    groups = re.findall(r"[0-9]+", span)
    near = before.rsplit("\n", 1)[-1]
    local = re.split(r"(?i)[\[({ ]at[\])} ]", span, maxsplit=1)[0].strip() if kind == "email" else ""
    return [
        KINDS.index(kind), len(span), len(digits), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        float(luhn(digits)) if digits else 0.0, len(set(digits)), span.count("/"), span.count("."), span.count("-"), span.count(" "), float("(" in span and ")" in span),
        float(bool(re.search(r"[\[({](?:at|dot)", span.lower()))), float(" dot " in span.lower()), float(bool(re.search(r"(?i)(?<![^ .\])}])(?:com|org|net|edu|io|de|fr|es|uk)$", span))),
        float(len(groups) == 3 and groups[0][:2] in ("19", "20") and len(groups[0]) == 4), float(before[-1:].isalnum()), float(after[:1].isalnum()),
        span.count(":"), float("::" in span), float(bool(re.search(r"[0-9._%+-]", local))), float(". " in span), float(" at " in span.lower()),
        float(kind == "ip" and bool(re.search("[A-Fa-f]", span))), float(len(set(map(len, span.split(":")))) > 1),
        len(groups[0]) if groups else 0, float(span[:1] == "0"), float(span[:1] == "1" and len(digits) == 11), float(bool(re.search(" [./-] ", span))), float("(0)" in span),
        float(bool(re.fullmatch(r"(?i)\S+ at (?:\S+ dot )+(?:com|org|net|edu|io|de|fr|es|uk)", span))),
        *[float(bool(p.search(near))) for _, p in _TELL],
    ]


def _examples(n: int, seed: int) -> list[tuple[str, int, int, str, int]]:
    """(text, start, end, kind, is personal data), from templates."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice(("an", "er", "on", "th", "re", "st", "la", "de", "ou", "ing", "ver")) for _ in range(r.randint(1, 4)))
    number = lambda k: "".join(r.choice("0123456789") for _ in range(k))

    def card(valid: bool) -> str:
        while luhn(x := number(16)) != valid:
            pass
        sep = r.choice((".", "_", "/", "  ", " - "[:2]))
        return sep.join(x[i : i + 4] for i in range(0, 16, 4))

    def one() -> tuple[str, str, str, int]:
        """Kind, lead, span, truth."""
        what = r.randrange(12)
        filler = " ".join(word() for _ in range(r.randint(1, 6)))
        if what == 0:
            at, dot = r.choice((("[at]", "[dot]"), ("(at)", "(dot)"), (" (at) ", "."), (" [at] ", " [dot] "), (" at ", " dot "), ("{at}", "{dot}")))
            return "email", r.choice((filler, "mail: ", "contact me: ", filler)), f"{word()}{r.choice(('', '.', number(2)))}{word()}{at}{word()}{dot}{r.choice(('com', 'org', 'net', 'de', 'fr', 'es', 'io'))}", 1
        if what == 1:
            return "email", filler, f"{word()} at {word()} dot {word()}", 0
        if what in (2, 3):
            form = r.choice(("({3}) {3}-{4}", "{3}-{3}-{4}", "{3}.{3}.{4}", "{5} {3} {4}", "00{2} {3} {3} {4}", "({3}) {3} {4}"))
            span = re.sub(r"\{(\d)\}", lambda m: number(int(m[1])), form)
            return "phone", r.choice(("call ", "tel: ", "phone ", "my mobile is ", "fax ", "Telefon ", "whatsapp ")), span, 1
        if what == 4:
            return "phone", r.choice(("on ", "date ", filler)), f"{r.choice(('19', '20'))}{number(2)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}", 0
        if what == 5:
            return "phone", r.choice(("on ", "date: ", filler)), f"{r.randint(1, 28):02d}{(s := r.choice('./-'))}{r.randint(1, 12):02d}{s}{r.choice(('19', '20'))}{number(2)}", 0
        if what == 6:
            return "phone", r.choice(("order ", "invoice no. ", "version ", "isbn ", "ref ", "total ", filler)), r.choice((" ", "-", ".")).join(number(r.randint(2, 5)) for _ in range(r.randint(3, 5))), 0
        if what == 7:
            return "phone", filler, re.sub(r"\{(\d)\}", lambda m: number(int(m[1])), r.choice(("{3} {3} {3}", "{2} {2} {2} {2}", "{4} {4} {4}", "{3}-{2}-{4}", "{5} {5} {5}"))), 0
        if what == 8:
            return "card", r.choice(("card ", "visa ", "paid with ", "my credit card: ", filler)), card(True), 1
        if what == 9:
            return "card", r.choice(("order ", "serial ", filler, "card ")), card(False), 0
        if what == 10:
            return "ip", r.choice(("login from ", "host ", "ip ", filler)), ":".join("%x" % r.randrange(65536) for _ in range(8)), 1
        return "ip", r.choice(("serial ", "ref ", "version ")), ":".join(number(2) for _ in range(8)), 0

    out = []
    for _ in range(n):
        kind, lead, span, truth = one()
        text = f"{word()} {word()} {lead.strip()} {span}"
        start = len(text) - len(span)
        out.append((text + r.choice(("", ".", ", ", " ")) + " " + word(), start, start + len(span), kind, truth))
    return out


def _further(n: int, seed: int) -> list[tuple[str, int, int, str, int]]:
    """Such examples of addresses written with a plain dot, and of compressed version-6 addresses."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice(("an", "er", "on", "th", "re", "st", "la", "de", "ou", "ing", "ver")) for _ in range(r.randint(1, 4)))
    ending = lambda: r.choice(("com", "org", "net", "de", "fr", "es", "io"))
    group = lambda: "%x" % r.choice((r.randrange(16), r.randrange(256), r.randrange(65536), r.randrange(65536)))
    digit = re.compile(r"[0-9]")

    def address() -> str:
        if r.random() < 0.25:
            return ":".join((r.choice(("2001:db8", "2a02:" + group(), "fd00:" + group())), *(r.choice(("0", "0", group())) for _ in range(6))))
        head = r.choice(("2001:db8", "fe80", "fd00", "2a02:" + group(), "2606:" + group(), "", group() + ":" + group()))
        tail = [group() for _ in range(r.randint(0 if head else 1, 4))]
        out = head + "::" + ":".join(tail)
        return out if digit.search(out) else address()

    def one() -> tuple[str, str, str, int]:
        what, filler = r.randrange(9), " ".join(word() for _ in range(r.randint(1, 6)))
        if what == 8:
            return "email", r.choice((filler, filler, "my address is ", "write ")), f"{word()}{r.choice(('', '', '.', '_'))}{word()} at {word()} dot {ending()}", 1
        if what in (0, 1):
            return "email", r.choice((filler, "mail: ", "please mail ", "contact me: ", "write to ")), f"{word()}{r.choice('._-')}{r.choice((word(), str(r.randrange(100))))} at {word()}.{ending()}", 1
        if what == 2:
            return "email", filler, f"{word()} at {word()}.{ending()}", 0
        if what == 3:
            return "email", r.choice((filler, "mail ", "contact ", "write ")), f"{r.choice((word(), str(r.randrange(3000)), word() + '-' + word()))} at {word()}. {word().capitalize()}", 0
        if what in (4, 5):
            return "ip", r.choice(("login from ", "host ", "ip ", "ping ", filler)), address(), 1
        if what == 6:
            return "ip", r.choice(("class ", "call ", "use ", "namespace ", filler)), "::".join(r.choice(("a", "b", "add", "bad", "cafe", "face", "dead", "beef", "fed", "ace", "be", "de")) for _ in range(2)), 0
        return "ip", r.choice(("serial ", "ref ", "version ", "id ")), ":".join(str(r.randrange(10, 100)) for _ in range(8)), 0

    out = []
    for _ in range(n):
        kind, lead, span, truth = one()
        text = f"{word()} {word()} {lead.strip()} {span}"
        out.append((text + r.choice(("", ".", ", ", " ") if kind == "email" else ("", ", ", " ")) + " " + word(), len(text) - len(span), len(text), kind, truth))
    return out


def _numbers(n: int, seed: int) -> list[tuple[str, int, int, str, int]]:
    """Such examples of phone numbers of two groups and of card numbers of 13 to 15 digits, and of what looks like them."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice(("an", "er", "on", "th", "re", "st", "la", "de", "ou", "ing", "ver")) for _ in range(r.randint(1, 4)))
    number = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    called = ("call ", "tel ", "tel: ", "phone ", "my mobile is ", "fax ", "Telefon ", "whatsapp ", "phone: ")
    other = ("order ", "pages ", "from ", "score ", "total ", "ref ", "in ", "about ", "room ", "price ", "version ")

    def card(valid: bool) -> str:
        size = r.choice((13, 14, 15, 15))
        while luhn(x := r.choice("3456") + number(size - 1)) != valid:
            pass
        return x if r.random() < 0.6 else f"{x[:4]} {x[4:10]} {x[10:]}"

    def one() -> tuple[str, str, str, int]:
        what, filler = r.randrange(6), " ".join(word() for _ in range(r.randint(1, 6))) + " "
        two = r.choice((f"0{number(2)} {number(7)}", f"{number(3)}-{number(4)}", f"0{number(3)} {number(6)}", f"0{number(3)}/{number(5)}", f"({number(3)}) {number(7)}"))
        if what == 0:
            return "phone", r.choice(called), two, 1
        if what == 1:
            return "phone", filler, two, 0
        if what == 2:
            return "phone", r.choice((*other, filler)), r.choice(("-", " ", ".", "/")).join(number(r.randint(2, 4)) for _ in range(2)), 0
        if what == 3:
            return "card", r.choice(("card ", "visa ", "paid with ", "credit card: ", "payment by ")), card(True), 1
        if what == 4:
            return "card", r.choice((*other, filler, "card ")), card(False), 0
        return "card", r.choice((*other, "serial ", filler)), card(r.random() < 0.3), 0

    out = []
    for _ in range(n):
        kind, lead, span, truth = one()
        text = f"{word()} {word()} {lead}{span}"
        out.append((text + r.choice(("", ".", ", ", " ")) + " " + word(), len(text) - len(span), len(text), kind, truth))
    return out


def _wide(n: int, seed: int) -> list[tuple[str, int, int, str, int]]:
    """Such examples of phone numbers with a leading digit, with parts in brackets or far apart, or in one run of digits."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice(("an", "er", "on", "th", "re", "st", "la", "de", "ou", "ing", "ver")) for _ in range(r.randint(1, 4)))
    filled = lambda forms: re.sub("#", lambda _: r.choice("0123456789"), r.choice(forms))
    called = ("call ", "tel: ", "phone ", "dial ", "my cell: ", "ring ", "text me at ", "Rufen Sie mich an: ", "ruf an ", "Handy ", "erreichbar unter ", "llámame al ", "mi móvil es ", "teléfono ", "appelez le ", "mon portable : ", "joindre au ", "my number is ", "Büro: ", "office ", "meine Nummer ist ", "mi número es ", "mon numéro est ")
    other = ("order ", "ticket ", "order number: ", "invoice number is ", "score ", "total ", "ref ", "id ", "serial ", "invoice ", "version ", "Seite ", "pedido ", "commande ", "price ", "ratio ", "lot ")
    fine = ("1-8##-###-####", "1 ### ### ####", "1.###.###.####", "1 (###) ###-####", "(###) ### - ####", "0### / #######", "0## / ### ## ##", "0## - #######", "00## (0)### ######", "0##########", "0########", "#########", "##########", "0# ## ## ## ##", "9## ### ###")
    odd = ("# / #######", "#-##-###", "1 ### ###", "#.###.###", "## / ####", "# ### ### ###", "#########", "##########", "############", "###-###-###-###", "# - ## - ######", "#-###-#####-#")

    out = []
    for _ in range(n):
        filler, what = " ".join(word() for _ in range(r.randint(1, 6))) + " ", r.randrange(5)
        if what < 2:
            lead, span, truth = r.choice(called), filled(fine), 1
        elif what == 2:
            lead, span, truth = r.choice((*other, filler)), filled(odd), 0
        elif what == 3:
            lead, span, truth = r.choice((*other, filler)), filled(fine), 0
        else:
            lead, span, truth = filler, filled(odd), 0
        text = f"{word()} {word()} {lead}{span}"
        out.append((text + r.choice(("", ".", ", ", " ")) + " " + word(), len(text) - len(span), len(text), "phone", truth))
    return out


#: Sentences, leads and forms that training doesn't use, in which thresholds are set: (kind, is personal data, lead, form).
#: In a form, # is a digit, ~ a hexadecimal group, @ a name, and C and X a card number that passes or fails its check.
_CARRIERS = (
    "The committee met on Tuesday and agreed on the plan{}, which nobody had expected.", "Wir haben gestern lange darüber gesprochen{} und sind uns einig geworden.",
    "La reunión terminó tarde{} y todos volvieron a casa.", "Il faut encore vérifier les chiffres{} avant la fin du mois.", "- done{}\n- open: the rest", "Notes{} (see above)",
)
_FORMS = (
    ("phone", 1, "; you can phone me on ", "(0##) #### ####"), ("phone", 1, ", Telefon ", "0## #######"), ("phone", 1, ", tel ", "###-####"), ("phone", 1, ", please call ", "### ### ####"), ("phone", 1, "; teléfono o whatsapp: ", "6## ## ## ##"),
    ("phone", 1, ", call toll-free ", "1-800-###-####"), ("phone", 1, "; man erreicht mich unter ", "0### / ######"), ("phone", 1, "; llámanos al ", "9########"), ("phone", 1, "; vous pouvez me joindre au ", "0#########"), ("phone", 1, ", ruf mich an: ", "0### #######"),
    ("phone", 0, ", ticket ", "##########"), ("phone", 0, ", of ", "#.###.###"), ("phone", 0, ", parcel ", "1-###-###-####"), ("phone", 0, ", about ", "### / ######"), ("phone", 0, ", account ", "0#########"),
    ("phone", 0, " on ", "0#/0#/20##"), ("phone", 0, ", invoice ", "####-####"), ("phone", 0, ", total ", "### ###"), ("phone", 0, ", pages ", "###-###"), ("phone", 0, " between ", "19##-20##"), ("phone", 0, ", version ", "##.##.###"), ("phone", 0, " with ", "## ### ###"),
    ("email", 1, ", write to ", "@.@ [at] @ [dot] org"), ("email", 1, "; kontakt: ", "@##(at)@.de"), ("email", 1, ", mail ", "@_@ at @ dot com"), ("email", 0, " and we looked ", "@ at @"), ("email", 0, " when she arrived ", "@ at @. @"), ("email", 0, " as ", "@ at @ dot @"),
    ("card", 1, ", paid by card ", "C"), ("card", 1, "; my visa: ", "C"), ("card", 0, ", order ", "X"), ("card", 0, ", serial no. ", "X"), ("card", 0, " with ", "X"),
    ("ip", 1, " from the host ", "2001:db8::~:~"), ("ip", 1, ", server ", "fe80::~:~:~:~"), ("ip", 1, ", address ", "~:~:~:~:~:~:~:~"), ("ip", 0, ", ref ", "##:##:##:##:##:##:##:##"),
)


def planted(n: int, seed: int) -> list[tuple[str, int, int, str, int]]:
    """Examples put into those sentences."""
    r, out = random.Random(seed), []
    names = ("maria", "k.lind", "tobias", "info", "press", "orchard", "millbrook", "northgate", "delacroix", "sven")

    def card(valid: bool) -> str:
        size = r.choice((13, 15, 16))
        while luhn(x := "4" + "".join(r.choice("0123456789") for _ in range(size - 1))) != valid:
            pass
        return " / ".join(x[i : i + 4] for i in range(0, 16, 4)).replace(" / ", r.choice(".")) if size == 16 else x

    while len(out) < n:
        kind, truth, lead, form = r.choice(_FORMS)
        span = re.sub("[#~@CX]", lambda m: {"#": lambda: r.choice("0123456789"), "~": lambda: "%x" % r.randrange(1, 65536), "@": lambda: r.choice(names), "C": lambda: card(True), "X": lambda: card(False)}[m[0]](), form)
        before, after = r.choice(_CARRIERS).split("{}")
        text = before + lead + span + after
        start = len(before) + len(lead)
        out.append((text, start, start + len(span), kind, truth))
    return out


@cache
def model(n: int = 3000, seed: int = 11) -> tuple[Boosted, dict[str, float]]:
    """Trees, and for each kind the lowest threshold that reaches the precision on planted spans."""
    made_up = _examples(n, seed) + _further(n // 2, seed) + _numbers(n // 2, seed) + _wide(n // 2, seed)
    random.Random(seed).shuffle(made_up)
    trees = Boosted().fit(np.array([features(t, k, a, b) for t, a, b, k, _ in made_up]), np.array([e[4] for e in made_up]))
    # Each candidate that those texts give is judged by whether it overlaps what was planted as personal data.
    held_out = planted(n, seed) + _examples(n // 2, seed + 1) + _further(n // 2, seed + 1) + _numbers(n // 2, seed + 1) + _wide(n // 2, seed + 1)
    found = [(t, c, c[1] < e and s < c[2] and y) for t, s, e, _, y in held_out for c in candidates(t)]
    p, truth, kinds = trees.probability(np.array([features(t, *c) for t, c, _ in found])), np.array([y for *_, y in found], bool), np.array([c[0] for _, c, _ in found])
    least = {}
    for kind in KINDS:
        own = [(c, truth[(kinds == kind) & (p >= c)]) for c in np.unique(p[kinds == kind])]
        fine = [c for c, t in own if c >= 0.5 and len(t) and t.mean() >= PRECISION]
        below = [c for c, _ in own if fine and c < fine[0]]
        least[kind] = max(0.5, float(fine[0] + max(below, default=0.0)) / 2) if fine else 1.1  # halfway to the next score
    return trees, least


class _Taken:
    """Disjoint intervals, searched by bisection."""

    def __init__(self, spans=()):
        self.at: list[tuple[int, int]] = []
        for a, b in sorted(spans):
            if self.at and a < self.at[-1][1]:
                self.at[-1] = (self.at[-1][0], max(b, self.at[-1][1]))
            else:
                self.at.append((a, b))

    def meets(self, a: int, b: int) -> bool:
        i = bisect_left(self.at, (a, a))
        return i > 0 and self.at[i - 1][1] > a or i < len(self.at) and self.at[i][0] < b

    def add(self, a: int, b: int) -> None:
        insort(self.at, (a, b))


def all_spans(text: str, trees: Boosted, least: dict[str, float]) -> tuple[list, list]:
    """Base spans, and all spans; both by kind, then start."""
    base = base_spans(text)
    order = lambda x: (KINDS.index(x[0]), x[1], x[2])
    base.sort(key=order)
    held = _Taken((a, b) for _, a, b in base)
    more = [c for c in candidates(text) if not held.meets(c[1], c[2])]
    if not more:
        return base, base
    p = trees.probability(np.array([features(text, *c) for c in more]))
    taken: list = []
    for chance, c in sorted(zip(p.tolist(), more, strict=True), key=lambda x: (-x[0], x[1][1], x[1][2])):
        if chance >= least[c[0]] and not held.meets(c[1], c[2]):
            taken.append(c)
            held.add(c[1], c[2])
    return base, sorted(base + taken, key=order)


def redacted(text: str | None, spans: list) -> str | None:
    """text with each run of overlapping spans replaced by its first span's kind in brackets."""
    if not text or not spans:
        return text
    out, end = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def find_pii(docs: DataFrame) -> DataFrame:
    """Each document's columns, base and all spans as kind:start:end lists, and the redacted text."""
    ship(docs.sparkSession)
    trees, least = model()
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    schema = pa.schema([*[(c, kinds[k]) for c, k in DOCUMENT.items()], ("base", pa.list_(pa.string())), ("all_spans", pa.list_(pa.string())), ("redacted", pa.string())])

    def run(batches):
        for b in small_batches(batches):
            texts = b.column("text").to_pylist()
            found = [all_spans(t or "", trees, least) for t in texts]
            show = lambda spans: [f"{k}:{i}:{j}" for k, i, j in spans]
            yield made({**{c: b.column(c) for c in DOCUMENT}, "base": [show(x) for x, _ in found], "all_spans": [show(x) for _, x in found], "redacted": [redacted(t, x) for t, (_, x) in zip(texts, found, strict=True)]}, schema)

    out = ", ".join([*[f"{c} {k}" for c, k in DOCUMENT.items()], "base array<string>", "all_spans array<string>", "redacted string"])
    return pick(docs, DOCUMENT).mapInArrow(run, out)


def digest(docs: DataFrame) -> DataFrame:
    """The spans alone, counted and hashed; texts stay on the executors."""
    ship(docs.sparkSession)
    trees, least = model()
    schema = pa.schema([("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()), ("spans", pa.string()), ("n_spans", pa.int64())])

    def run(batches):
        for b in small_batches(batches):
            out = []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                base, every = all_spans(text or "", trees, least)
                show = ",".join(f"{k}:{i}:{j}" for k, i, j in base)
                out.append((doc_id, *[sum(s[0] == k for s in base) for k in KINDS], hashlib.sha256(show.encode()).hexdigest(), ",".join(f"{k}:{i}:{j}" for k, i, j in every), len(every)))
            yield made(dict(zip(schema.names, zip(*out, strict=True), strict=True)), schema)

    return pick(docs, {"doc_id": "bigint", "text": "string"}).mapInArrow(run, "doc_id bigint, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base_sha256 string, spans string, n_spans bigint")


def query(spark, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))
