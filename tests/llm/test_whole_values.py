"""Secrets are changed to their end, and dates in each form that is named."""

import random
import re
import string
import time

import pytest

from newslake.llm import pii

KEY = pii.Feistel(b"test")


@pytest.mark.parametrize("head", ["token=", "PASSWORD=", "API_KEY: ", 'Secret = "', "apiKey="])
@pytest.mark.parametrize("value", ["eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9P==",
                                   "a1B2c3D4" * 40, "0123456789abcdef" * 30])
def test_a_secret_is_changed_to_its_end(head, value):
    new, found = pii.pseudonymise(f"x {head}{value} y", KEY)
    made = new[len(f"x {head}"):-2]
    assert found == ["secret"] and len(made) == len(value)
    for k in range(0, len(value) - 8, 8):
        assert made[k:k + 8] != value[k:k + 8]
    assert pii.pseudonymise(new, KEY, undo=True)[0] == f"x {head}{value} y"


def test_a_very_long_secret_takes_time_by_its_length():
    value, begun = "".join(random.Random(1).choices(string.ascii_letters + string.digits, k=200_000)), time.process_time()
    new, _ = pii.pseudonymise(f"token={value}", KEY)
    assert len(new) == len(value) + 6 and new[-20:] != value[-20:] and time.process_time() - begun < 20


@pytest.mark.parametrize("value", ["12/25/2020", "1/2/2020", "1/25/2020", "5.12.2020", "12-5-2020", "2020-1-2", "25 December 2020",
                                   "5 Dec 2020", "05 May 1999", "25 Sep. 2020", "31.12.1999"])
def test_a_date_keeps_its_form_and_comes_back(value):
    for key in (pii.Feistel(bytes([k])) for k in range(40)):
        new, found = pii.pseudonymise(f"on {value}, he", key)
        made = new[3:-4]
        assert found == ["date"]
        assert re.sub(r"[A-Za-z]+", "m", re.sub(r"\d", "0", made)) == re.sub(r"[A-Za-z]+", "m", re.sub(r"\d", "0", value))
        assert pii.pseudonymise(new, key, undo=True) == (f"on {value}, he", ["date"])


def test_what_is_no_date_stays():
    for text in ("13/13/2020", "02/30/2020", "2020-13-1", "31 February 2020", "0/5/2020", "1/2/20"):
        assert pii.pseudonymise(text, KEY) == (text, []), text
