"""Texts with known personal data, made up from formats: the labels by which the trees of numbers, mail and street addresses are fitted.

A sample is written from a format and a setting, and its label is what it was written as: a phone number, an
identity number, a mail or street address, or something that only looks like one (a date, a lot, an account, a price, a year
before a name). No rule of the finder takes part in labelling.
"""

from __future__ import annotations

import random
import string

# Number formats in public use; 9 stands for a digit, A for a capital letter.
PHONES = (
    "+1 999 999 9999", "1-999-999-9999", "(999) 999-9999", "999.999.9999", "999-999-9999", "999 999 9999", "+33 9 99 99 99 99", "+44 99 9999 9999", "+49 99 99999 999", "+40 799 999 999", "+41 99 999 99 99",
    "099 9999 9999", "09 99 99 99 99", "0999 999 999", "(099) 999 9999", "+1 (999) 999-9999",
)
IDENTITIES = ("999-99-9999", "999 99 9999", "9999999999999", "9999 9999 9999 9999", "9999-9999-9999-9999", "A9999999", "AA999999", "AA9999999", "A99999999", "AA 99 99 99 A")
OTHERS = ("999-99-9999", "999 99 9999", "9999999999", "9999999999999", "9999 9999 9999 9999", "999999", "99-999999", "999-999", "AA999999", "A9999999", "999 999 999", "9999-9999", "999-999-9999", "999.999.9999")
_SAID = ("called", "wrote", "the harbour", "yesterday", "as agreed", "with regards", "for the survey", "before noon", "and later", "in the hall", "their letter", "since spring", "the clerk")
_PHONE_LEADS = ("", "", "phone ", "tel. ", "Tel. ", "M: ", "T ", "mobile ", "call ", "Call me at ", "reach her at ", "fax ", "and phone ", "kept ", "my cell is ", "ring ")
_ID_LEADS = ("ID ", "with ID ", "passport ", "passport no. ", "identity card: ", "Passport or identity card: ", "card number ", "social security number ", "SSN ", "personal number ", "national id ", "The form shows the number ", "The form shows the quiet number ", "identity number ", "with ", "shows the ")
_OTHER_LEADS = ("lot ", "lot no. ", "invoice ", "Invoice ", "docket ", "account ending ", "account ", "batch ", "file ", "box ", "item ", "order ", "ref. ", "reference ", "drawing ", "total ", "version ", "shelf ", "tray ", "page ", "refers to ", "Invoice INV-0007-00012 refers to ", "Invoice INV-0031 refers to lot ")
_STREETS = ("Harbour", "Granary", "Saddler", "Mill", "Chapel", "Old Quarry", "Long Meadow", "King", "Station", "Upper Well", "Orchard")
_ROADS = ("Street", "St.", "Road", "Lane", "Avenue", "Court", "Square", "Way", "Row", "Drive", "Place", "Hill", "Gardens")
_TOWNS = ("Ardwell", "Bellmoor", "Castrine", "Dunmere", "Elmhaven", "Farwick", "Grauheim", "Holmstad", "Istervale")
_MONTHS = ("January", "March", "May", "June", "August", "October", "December")


def _fill(form: str, rng: random.Random) -> str:
    return "".join(rng.choice(string.digits) if c == "9" else rng.choice(string.ascii_uppercase) if c == "A" else c for c in form)


def _around(rng: random.Random) -> tuple[str, str]:
    lead = " ".join(rng.sample(_SAID, rng.randrange(0, 3)))
    tail = rng.choice((". ", ", ", " ", "\n", ".\n\n")) + " ".join(rng.sample(_SAID, rng.randrange(0, 3)))
    return (lead + rng.choice((" ", ". ", "\n")) if lead else rng.choice(("", "\n"))), tail


def _placed(value: str, lead: str, rng: random.Random, tail: str | None = None) -> tuple[str, int, int]:
    before, after = _around(rng)
    if lead.endswith(" ") and rng.random() < 0.25:
        lead = lead[:-1] + "\n"
    text = before + lead
    return text + value + (after if tail is None else tail + after), len(text), len(text) + len(value)


def _led(leads: tuple[str, ...], rng: random.Random) -> str:
    """What announces a number; sometimes a word that announces another kind stands further before it."""
    lead = rng.choice(leads)
    if rng.random() < 0.3:
        far = rng.choice((*_OTHER_LEADS, *_PHONE_LEADS, *_ID_LEADS, "P.O. Box ")).strip()
        lead = f"{far} {rng.choice((str(rng.randrange(9, 99)), 'of the clerk', ''))}{rng.choice((', ', ' '))}{rng.choice(_TOWNS + _SAID)} {rng.choice(('and kept', 'and', 'with', 'then'))} {lead}"
    return lead


def numbers(count: int, seed: int = 11) -> list[tuple[str, int, int, str]]:
    """(text, start, end, label): ``phone``, ``idno`` or the empty string."""
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        kind = rng.choice(("phone", "idno", "other", "date", "bare"))
        if kind == "phone":
            value = _fill(rng.choice(PHONES), rng) + (rng.choice((" ext. 999", " x99", ", ext. 9999")).replace("9", rng.choice(string.digits)) if rng.random() < 0.15 else "")
            if rng.random() < 0.05 and " " in value:
                value = value.replace(" ", "\n", 1)
            # a page number or the next list item may follow on the next line
            tail = rng.choice((f"\n{rng.randrange(1, 40)}\n", f".\n\n{rng.randrange(1, 40)}. ", f"\n- {rng.randrange(1, 40)} -\n", f".\n\n0{rng.randrange(1, 9)} Nov ")) if rng.random() < 0.2 else None
            out.append((*_placed(value, _led(_PHONE_LEADS, rng), rng, tail), "phone"))
        elif kind == "idno":
            lead = _led(_ID_LEADS, rng)
            tail = rng.choice((" next to the name ", ", holder ")) if rng.random() < 0.4 or lead.endswith(("number ", "the ")) else None
            out.append((*_placed(_fill(rng.choice(IDENTITIES), rng), lead, rng, tail), "idno"))
        elif kind == "other":
            out.append((*_placed(_fill(rng.choice(OTHERS), rng), _led(_OTHER_LEADS, rng), rng), ""))
        elif kind == "date":
            d, m, y = rng.randrange(1, 29), rng.randrange(1, 13), rng.randrange(1950, 2030)
            value = rng.choice((f"{d:02d}.{m:02d}.{y}", f"{d:02d}-{m:02d}-{y}", f"{y}-{m:02d}-{d:02d}", f"{d}.{m}.{y}", f"{y}.{m:02d}.{d:02d}", f"{y}{m:02d}{d:02d}"))
            out.append((*_placed(value, rng.choice(("", "Am ", "on ", "Sent: ", "Date: ", "since ", "le ")), rng), ""))
        elif rng.random() < 0.3:
            # the seconds of a time with fraction and offset
            lead = f"{rng.choice(('Sent: ', 'Date: ', ''))}{rng.randrange(2000, 2030)}-0{rng.randrange(1, 10)}-{rng.randrange(10, 29)}T{rng.randrange(10, 24)}:{rng.randrange(10, 60)}:"
            out.append((*_placed(_fill("99.999999-09", rng), lead, rng, ":00"), ""))
        else:
            # a number that nothing announces, as in a table or after a colon of a header
            out.append((*_placed(_fill(rng.choice(("9999999999", "9999999999999", "999999", "9999 9999", "99 999 999", "999 999", "99999-99999")), rng), rng.choice(("Sent: ", "Date: ", "", "From: ", "about ", "of ")), rng), ""))
    return out


def mails(count: int, seed: int = 12) -> list[tuple[str, int, int, str]]:
    """(text, start, end, label) of things with a mail sign: ``email`` or the empty string."""
    rng = random.Random(seed)
    word = lambda a, b: "".join(rng.choices(string.ascii_lowercase, k=rng.randrange(a, b)))
    out = []
    for _ in range(count):
        local = rng.choice((word(3, 12), word(3, 9) + "." + word(3, 9), word(3, 9) + "_" + word(3, 9), word(3, 9) + str(rng.randrange(99)), word(1, 2) + word(4, 9)))
        host = rng.choice((word(1, 4), word(4, 12), word(4, 12))) + rng.choice(("", "." + word(2, 6)))
        top = rng.choice(("com", "org", "net", "de", "fr", "info", "test", "example", "invalid", "co.uk"))
        if rng.random() < 0.5:
            at, dot = rng.choice((("@", "."), ("@", "."), ("@", "."), (" [at] ", "."), (" (at) ", " dot "), (" at ", " dot ")))
            value = local + at + (host + "." + top).replace(".", dot)
            value = value.upper() if rng.random() < 0.1 else value
            out.append((*_placed(value, rng.choice(("", "<", "write to ", "From: ", "mailto:", '"')), rng), "email"))
        else:
            value = rng.choice((f"{rng.randrange(9, 999)}@{rng.randrange(1, 99)}.{rng.randrange(10, 99)}", f"{word(3, 8)}@{rng.randrange(1, 9)}.{rng.randrange(1, 9)}.{rng.randrange(1, 9)}", f"{word(2, 5)}@{word(2, 4)}.{rng.choice(string.digits)}", f"{rng.randrange(9)}@{word(1, 2)}.{rng.choice(string.ascii_lowercase)}"))
            out.append((*_placed(value, rng.choice(("", "sold ", "version ", "about ")), rng), ""))
    return out


def addresses(count: int, seed: int = 13) -> list[tuple[str, int, int, str]]:
    """(text, start, end, label) of things built like an address: ``address`` or the empty string."""
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        town, code, n = rng.choice(_TOWNS), str(rng.randrange(10000, 99999)), str(rng.randrange(1, 480))
        street = f"{rng.choice(_STREETS)} {rng.choice(_ROADS)}"
        if rng.random() < 0.7:
            flat = rng.choice(("", "", "Apt 12, ", "Flat 4, ", "Unit 7B, ", "Suite 300, "))
            value = rng.choice((f"{flat}{n} {street}, {town} {code}", f"{flat}{n} {street}, {town}", f"{n} rue de la {rng.choice(_STREETS).split()[0]}, {code} {town}", f"{n} avenue du {rng.choice(_STREETS).split()[0]}, {code} {town}", f"{rng.choice(_STREETS).split()[0]}straße {n}, {code} {town}", f"{rng.choice(_STREETS).split()[0]}weg {n}, {code} {town}", f"P.O. Box {n}, {town}", f"PO Box {n}, {town} {code}"))
            value = value.upper() if rng.random() < 0.05 and "rue" not in value and "avenue" not in value else value
            value = value.replace(" ", "\n", 1) if rng.random() < 0.1 else value
            out.append((*_placed(value, rng.choice(("", "at ", "lives at ", "held at ", "to ", "in ", "address: ", "write to ")), rng), "address"))
        else:
            # a year or a count before a name that ends like a street, then another name
            value = f"{rng.randrange(1950, 2030)} {street}, {town}"
            out.append((*_placed(value, rng.choice(("In ", "since ", f"{rng.choice(_MONTHS)} ", f"in {rng.choice(_MONTHS)} ", "until ", "before ")), rng), ""))
    return out
