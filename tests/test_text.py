import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from archivolt.functions import text
from archivolt.functions.similarity import lcs_length, ratio


def plain_fold(s):
    return "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn").lower()


def test_fold(column):
    words = ["Timișoara", "Vérouane", "Țarvina", "Höllmar", "château", "école", "", None, "Straße", "ÀÉ" * 5000]
    assert column(text.fold, words) == [None if w is None else plain_fold(w) for w in words]


def test_newlines_are_junk(column):
    assert column(text.clean_text, ["a\n\n\nb", "  x \t y ", None, ""]) == ["ab", "x y", "", ""]


def test_emails(column):
    assert column(text.normalize_email, ["x@agmail.com", "X@grnail.com ", "a®b.org", None]) == ["x@@gmail.com", "x@gmail.com", "a@b.org", None]
    assert column(text.extract_emails, ["To b@x.org, A@x.org and a@X.org", "none", ""]) == [["a@x.org", "b@x.org"], [], []]


def test_date_repairs(column):
    assert column(text.fix_date_ocr, ["Sep I, 2OO9", "8: 21", "l2:30", "Sept 5", None]) == ["Sep 1, 2009", "8:21", "12:30", "Sep 5", None]


def test_headers(column):
    get = lambda k: lambda c: text.headers(c)[k]
    assert column(get("to"), ["To:\nFrom: x", "To: a b \nx", "x\n" * 10 + "To: late"]) == ["From: x", "a b", ""]
    assert column(get("subject"), ["x\n" * 9 + "Subject: tenth", "x\n" * 10 + "Subject: eleventh"]) == ["tenth", ""]


def test_document_type(column):
    cases = {"data: interview": "interview", "to: from: q: a:": "email", "invoice": "other", "a newspaper": "article", "": "other", None: "other"}
    assert column(text.document_type, list(cases)) == list(cases.values())


def test_participants(column):
    got = column(text.clean_participant, ["Ann Lee <A@X.org>", "a@x.org", "On Mon", "x wrote:", "Ann Lee", "12.5", None, "", "y" * 81, "Sent from my phone"])
    assert got == ["Ann Lee <a@x.org>", "a@x.org", "", "", "Ann Lee", "", "", "", "", ""]
    assert column(text.display_participant, ["<a@x.org>", "", None, "Ann"]) == ["[REDACTED]", "[Unknown]", "[Unknown]", "Ann"]


def test_duration(column):
    assert column(text.duration, [0.0, 59.4, 61.0, 3725.0], "v double") == ["0s", "59s", "1m 1s", "1h 2m"]


def test_body_form(column):
    assert column(text.normalize_body, ["> Hello,  World!\nOn Mon, Jan 5 2009 x wrote: Bye", None, "Subject: Re: x"]) == ["hello world bye", "", "x"]


@settings(max_examples=150, deadline=None)
@given(st.text("abcde", max_size=12), st.text("abcde", max_size=12))
def test_lcs_against_table(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    assert lcs_length(a, b) == t[-1][-1]


@pytest.mark.parametrize(("a", "b", "r"), [("abc", "abc", 100), ("", "", 100), (None, "x", 0), ("ab", "cd", 0), ("abcd", "abxd", 75)])
def test_ratio(a, b, r):
    assert ratio(a, b) == pytest.approx(r)


def test_damaged_mailboxes_are_set_right(column):
    fix = lambda c: text.normalize_email(c, mailboxes=("jane-holiday",))
    values = ["JaneHoliday@x.org", "jnholiday@x.org", "j.holiday@x.org", "annholiday@x.org", "johannesholiday@x.org", "holiday@x.org", None]
    assert column(fix, values) == ["janeholiday@x.org", "janeholiday@x.org", "janeholiday@x.org", "annholiday@x.org", "johannesholiday@x.org", "holiday@x.org", None]
