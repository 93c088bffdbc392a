"""Attributes with odd quotes lose no text and leave no markup."""

import pytest

from quire.llm.site_tree import blocks


@pytest.mark.parametrize("page,texts", [
    ("<p title=it's>Body one stays</p><p>don't lose this</p><p>end</p>", ["Body one stays", "don't lose this", "end"]),
    ("<div class=author's-note>Hello</div><p>It's fine</p>", ["Hello", "It's fine"]),
    ('<p title="open>Text', ["Text"]),
    ('<p =>a</p><p == x="1>2">b</p>', ["a", "b"]),
    ("<p title = \"a > b\" id=x>c</p><p title='a\"b'>d", ["c", "d"]),
    ("<br/><img src=a/b alt='x>y'>t", ["t"]),
    ('<p a="1"b="2">o</p>', ["o"]),
])
def test_text_around_odd_attributes(page, texts):
    assert [t for _, t, _ in blocks(page)] == texts


def test_many_open_quotes_are_read_in_linear_time():
    assert len(blocks('<p title="' * 50_000)) <= 1
    assert [t for _, t, _ in blocks("<p a=b c=\"d\" 'e>x</p>" * 3)] == ["x"] * 3
