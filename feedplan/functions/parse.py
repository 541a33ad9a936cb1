"""Parsers for the free-text cells of a feed (SQL text in, SQL text out).

A cell holds several facts in one string (``role=Engineer; hired:2020``).
Each parser is one or two regular expressions evaluated inside generated
code; nothing is split into arrays unless the caller asks for all pairs.
"""

from __future__ import annotations

from feedplan.functions.text import WS, one_of, regex, strip, trim_to_null

# Spellings of the logon flag.
FLAG_ON = ("true", "1", "yes", "y", "on")
FLAG_OFF = ("false", "0", "no", "n", "off")

# A token of a contact cell runs between these separators.
_SEP = r";|,"
_TOKEN = rf"[^{_SEP}]*"
# Fixed patterns: an address, and a phone number of six characters or more.
# Blanks at the end of a token do not count towards the six.
_EMAIL = rf"[^{WS}{_SEP}]@[^{WS}{_SEP}]"
_PHONE = rf"[+\d][\d{WS}()\-]{{4}}(?:[\d()\-]|[{WS}](?={_TOKEN}[^{WS}{_SEP}]))"


def _group(c: str, pattern: str) -> str:
    """First group of the first match, ``''`` without one."""
    return f"regexp_extract({c}, {regex(pattern)}, 1)"


def split_full_name(c: str) -> dict[str, str]:
    """Last, first and middle name.

    ``Last, First Middle`` when a comma is present, else ``Last First Middle``.
    Words are separated by blanks only; further words are ignored.
    """
    name = strip(c)
    to_comma = rf"[^,]*,[{WS}]*+"
    no_comma = r"(?![^,]*,)"
    word = r"[^ ]+ +"
    return {
        "last_name": trim_to_null(_group(name, rf"(?s)^((?=[^,]*,)[^,]*|{no_comma}[^ ]+)")),
        "first_name": trim_to_null(_group(name, rf"(?Us)^(?:{to_comma}|{no_comma}{word})([^ ]+)")),
        "middle_name": trim_to_null(_group(name, rf"(?Us)^(?:{to_comma}{word}|{no_comma}{word}{word})([^ ]+)")),
    }


def _labelled(label: str, form: str) -> str:
    """Lookahead: the token holds ``label=`` and, after its first ``=``, a
    value of the given form."""
    return rf"(?=[^{_SEP}]*{label}=)(?=[^={_SEP}]*={_TOKEN}{form})"


_EMAIL_LABELLED = _labelled("email", _EMAIL)
_PHONE_LABELLED = _labelled("phone", _PHONE)
_HAS_EMAIL = rf"(?={_TOKEN}{_EMAIL})"
_HAS_PHONE = rf"(?={_TOKEN}{_PHONE})"
_START = rf"(?iUs)(?:^|[{_SEP}])"

# First token that counts as an e-mail: labelled (the group then starts after
# its first "="), or any address in a token that is not a labelled phone.
_AFTER_LABEL = rf"[^={_SEP}]*="
_FIRST_EMAIL = rf"{_START}(?:{_EMAIL_LABELLED}{_AFTER_LABEL}|(?!{_PHONE_LABELLED}){_HAS_EMAIL})({_TOKEN})"
# First token that counts as a phone: a labelled phone that is no labelled
# e-mail, or a number in a token without an address.
_FIRST_PHONE = (
    rf"{_START}(?!{_EMAIL_LABELLED})(?:{_PHONE_LABELLED}{_AFTER_LABEL}|(?!{_HAS_EMAIL}){_HAS_PHONE})({_TOKEN})"
)


def pick_contacts(*cells: str) -> dict[str, str]:
    """First e-mail and first phone over the tokens of all cells, in order.

    The whole token is kept (or the text after its first ``=`` when it is
    labelled), not the part that matched.
    """
    joined = cells[0] if len(cells) == 1 else f"concat_ws(',', {', '.join(cells)})"
    # cheap scans first: most long texts hold neither
    email = f"if(contains({joined}, '@'), {_group(joined, _FIRST_EMAIL)}, '')"
    phone = f"if({joined} rlike {regex(f'(?U){_PHONE}')}, {_group(joined, _FIRST_PHONE)}, '')"
    return {"email": trim_to_null(email), "phone": trim_to_null(phone)}


def kv_value(c: str, key: str) -> str:
    """Value of one key in a ``k=v;k=v`` cell; the last duplicate wins, an
    empty value stays ``''``, an absent key gives NULL."""
    # the group starts at '=', so an empty value differs from no match
    found = _group(c, rf"(?iUs)^(?:.*;)?[{WS}]*{key}[{WS}]*(=[^;]*)")
    return strip(f"substr(nullif({found}, ''), 2)")


def kv_pairs(c: str) -> str:
    """All pairs of a ``k=v;k=v`` cell as a MAP; the last duplicate wins."""
    key = f"lower({strip('substring_index(t, \'=\', 1)')})"
    value = strip(f"regexp_replace(t, {regex('(?s)^[^=]*=')}, '')")
    pairs = (
        f"filter(transform(filter(split({c}, ';'), t -> contains(t, '=')), "
        f"t -> named_struct('key', {key}, 'value', {value})), p -> p.key != '')"
    )
    # the last entry of a key is the first one of the reversed list
    return (
        f"map_from_entries(aggregate(reverse({pairs}), cast(array() as array<struct<key:string,value:string>>), "
        f"(kept, p) -> if(array_contains(kept.key, p.key), kept, array_append(kept, p))))"
    )


def manager_ref(c: str) -> str:
    """Fixed pattern: first run of digits in ``manager_id: …`` / ``manager=…``, or in the
    whole cell when neither label occurs; leading zeros stay."""
    labelled = rf"(?iUs)^.*?(?:manager_id|manager)[{WS}]*[:=][{WS}]*([^;]+).*$"
    rest = f"regexp_replace({c}, {regex(labelled)}, '$1')"
    return f"nullif({_group(rest, r'(?U)(\d+)')}, '')"


def logon_flag(c: str) -> str:
    """Fixed pattern: ``'true'`` / ``'false'`` from ``disabled: …``; unknown words are NULL."""
    word = f"lower({strip(_group(c, rf'(?iU)disabled[{WS}]*[:=][{WS}]*([^;]+)'))})"
    return one_of(dict.fromkeys(FLAG_ON, "true") | dict.fromkeys(FLAG_OFF, "false"), word)


def role_name(c: str) -> str:
    """Fixed pattern: text after ``role=`` / ``role:`` up to the next ``;``."""
    return trim_to_null(_group(c, rf"(?iU)role[{WS}]*[:=][{WS}]*([^;]+)"))
