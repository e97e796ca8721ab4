from hypothesis import given, settings, strategies as st

from cardledger.operators.fold import fold_rows

ROWS = st.lists(
    st.tuples(st.integers(-300, 500), st.integers(-50, 800), st.booleans(), st.booleans()), max_size=40
)


def columns(rows):
    return [list(c) for c in zip(*rows)] if rows else [[], [], [], []]


@settings(max_examples=300, deadline=None)
@given(ROWS, st.integers(-400, 400))
def test_fold_is_the_rule_row_by_row(rows, pending):
    after, failed, _, _ = fold_rows(*columns(rows), pending)
    for (amount, room, guard, is_open), got, over in zip(rows, after, failed):
        assert over == (amount + (pending if guard else 0) >= room)
        if is_open and not over:
            pending += amount
        assert got == pending


@settings(max_examples=300, deadline=None)
@given(ROWS, st.integers(-400, 400), st.integers(-300, 300))
def test_verdicts_hold_while_the_start_stays_in_the_interval(rows, pending, shift):
    after, failed, down, up = fold_rows(*columns(rows), pending)
    moved, moved_failed, _, _ = fold_rows(*columns(rows), pending + shift)
    opens = [r[3] for r in rows]
    same = [f for f, o in zip(failed, opens) if o] == [f for f, o in zip(moved_failed, opens) if o]
    if down <= shift < up:
        assert same and moved == [p + shift for p in after]
    else:
        assert not same


@settings(max_examples=100, deadline=None)
@given(ROWS, st.integers(0, 40))
def test_fold_may_be_cut_anywhere(rows, cut):
    whole = fold_rows(*columns(rows), 0)
    first = fold_rows(*columns(rows[:cut]), 0)
    last = fold_rows(*columns(rows[cut:]), first[0][-1] if first[0] else 0)
    assert whole[0] == first[0] + last[0]
    assert whole[1] == first[1] + last[1]
