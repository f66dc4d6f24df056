"""Regular-expression matches with offsets, as Catalyst expressions."""

from __future__ import annotations


def literal(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


BLOCK = 256
#: Stands on both sides of a match while a text is cut: a code point that Unicode keeps from being a character.
MARK = "\ufdd0"


def match_spans(text: str, pattern: str) -> str:
    """SQL for the matches of a pattern in order, as array<struct<start, stop, words>> in code points.

    One pass marks the matches and a cut at the marks gives what lies between them and the matches in turn; a text that holds the mark itself
    takes two passes. (A cut by the pattern itself would compile it anew for every row.) Running sums of lengths give the offsets, block by block
    beyond ``BLOCK`` matches, so that many in one text stay cheap. The pattern mustn't match the empty string.
    """
    both = "length(x[2 * i]) + length(x[2 * i + 1])"
    before = f"aggregate(sequence(0, greatest(k * {BLOCK} - 1, 0)), 0, (n, i) -> if(k = 0, 0, n + {both}))"
    one = "named_struct('start', acc.at + length(x[2 * i]), 'stop', acc.at + length(x[2 * i]) + length(x[2 * i + 1]), 'words', x[2 * i + 1])"
    empty = "cast(array() as array<struct<start: int, stop: int, words: string>>)"
    last = "size(x) div 2 - 1"
    block = lambda first, to, at: f"aggregate(sequence({first}, {to}), named_struct('at', {at}, 'out', {empty}), (acc, i) -> named_struct('at', acc.at + {both}, 'out', concat(acc.out, array({one}))), acc -> acc.out)"
    many = f"flatten(transform(sequence(0, int(({last}) div {BLOCK})), k -> {block(f'k * {BLOCK}', f'int(least(k * {BLOCK} + {BLOCK - 1}, {last}))', before)}))"
    whole = f"case when size(x) < 2 then {empty} when size(x) = 3 then transform(array(named_struct('at', 0)), (acc, i) -> {one}) when size(x) < {2 * BLOCK} then {block('0', f'int({last})', '0')} else {many} end"
    marked = f"split(regexp_replace({text}, {literal(pattern)}, '{MARK}$0{MARK}'), '{MARK}')"
    between, found = literal(rf"\G((?s:.*?))(?:{pattern})"), literal(pattern)
    twice = f"concat(flatten(zip_with(regexp_extract_all({text}, {between}, 1), regexp_extract_all({text}, {found}, 0), (a, b) -> array(a, b))), array(''))"
    return f"transform(array(if(contains({text}, '{MARK}'), {twice}, {marked})), x -> {whole})[0]"
