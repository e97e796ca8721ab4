"""The same results in SQL, written for the check and independent of the Spark code."""

from __future__ import annotations

from cardledger.catalog import STREAM_STOPPED

CARDS = """
cards as (
  select o_orderkey as card_id, o_custkey as customer_id,
         cast(floor(o_totalprice / 100) * 100 as double) as credit_limit,
         cast(floor(o_totalprice * 0.05 * (o_custkey % 20)) as double) as current_balance
  from orders)"""

CUSTOMERS = """
customers as (
  select c_custkey as customer_id, c_name as name,
         case when c_custkey % 40 = 7 then '' else c_name || ', NY ' ||
           lpad(cast(c_nationkey % 3 * 10000 + c_custkey % 10000 as varchar), 5, '0') end as address,
         cast(300 + c_custkey % 551 as bigint) as credit_score
  from customer)"""

TX = """
tx as (
  select l_orderkey * 1000000 + row_number() over (
           partition by l_orderkey
           order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity,
                    l_discount, l_tax, l_returnflag, l_linestatus) as transaction_id,
         case when l_orderkey % 50 = 0 then -1 - l_orderkey else l_orderkey end as card_id,
         s_name as merchant_name, l_shipdate as ts,
         case when l_returnflag = 'R' then -l_extendedprice else l_extendedprice end as amount,
         s_name || ' ' || lpad(cast(s_nationkey % 3 * 10000 + s_suppkey % 10000 as varchar), 5, '0')
           as location,
         case when l_returnflag = 'R' then 'refund' else 'purchase' end as transaction_type
  from lineitem left join supplier on l_suppkey = s_suppkey)"""

# One card holds a third of the transactions.
CORPORATE_TX = """
corporate_tx as (
  select * replace (case when card_id % 3 = 0 then 1 else card_id end as card_id) from tx)"""

CORPORATE_CARDS = """
corporate_cards as (
  select * replace (case when card_id = 1 then 5e6 else credit_limit end as credit_limit,
                    case when card_id = 1 then 0.0 else current_balance end as current_balance)
  from cards)"""


LARGE_CARDS = """
large_cards as (
  select * replace (credit_limit * 100000 as credit_limit, current_balance * 100000 as current_balance) from cards)"""

LARGE_TX = """
large_tx as (select * replace (amount * 5000 as amount) from tx)"""


def joined(
    tx: str = "tx", cards: str = "cards", where: str = "true", arrival: str = "cast(t.ts as date)"
) -> str:
    """Each transaction with its card's data in cents and both zip codes."""
    return f"""
j as (
  select t.transaction_id, t.card_id, {arrival} as arrival_day,
         cast(round(t.amount * 100) as bigint) as amount_cents,
         c.card_id is not null as card_known, c.customer_id,
         cast(round(c.credit_limit * 100) as bigint) as limit_cents,
         cast(round(c.current_balance * 100) as bigint) as balance_cents,
         case when u.address <> '' then right(trim(u.address), 5) end as home_zip,
         right(trim(t.location), 5) as merchant_zip
  from {tx} t left join {cards} c on t.card_id = c.card_id
  left join customers u on c.customer_id = u.customer_id
  where {where})"""


RULES = """
r as (
  select *,
         case when not card_known then 'Card not found'
              when 2 * amount_cents >= limit_cents then 'Transaction exceeds 50% of credit limit'
         end as before_total,
         coalesce(amount_cents + balance_cents >= limit_cents, false) as total_fails,
         case when home_zip is null then 'Customer address not found'
              when length(home_zip) < 5 or length(merchant_zip) < 5
                   or left(home_zip, 1) <> left(merchant_zip, 1) then 'Merchant location too far'
         end as after_total
  from j)"""

VERDICTS = """
v as (
  select transaction_id, card_id, arrival_day, amount_cents,
         coalesce(before_total,
                  case when total_fails then 'Total balance exceeds credit limit' end,
                  after_total) as decline_reason
  from r)"""

UPDATES = """
updates as (
  select transaction_id, card_id,
         case when decline_reason is null then 'pending' else 'declined' end as status,
         decline_reason,
         cast(sum(case when decline_reason is null then amount_cents else 0 end) over (
           partition by card_id order by arrival_day, transaction_id
           rows unbounded preceding) as bigint) / 100 as pending_balance
  from v)"""

# The running limit: row by row along each card, in arrival order.
RUNNING = """
s as (
  select *, row_number() over w as n,
         coalesce(min(transaction_id) over (
           partition by card_id order by arrival_day, transaction_id
           rows between unbounded preceding and 1 preceding) < transaction_id, false) as guard
  from r window w as (partition by card_id order by arrival_day, transaction_id)),
f as (
  select s.*, false as fails, cast(0 as bigint) as pending from s where n = 0
  union all
  select s.*, g.fails, g.pending
  from s, lateral (select
    coalesce(s.amount_cents + s.balance_cents >= s.limit_cents, false) as fails,
    case when s.before_total is null and s.after_total is null
              and s.amount_cents + s.balance_cents < s.limit_cents
         then s.amount_cents else 0 end as pending) g
  where s.n = 1
  union all
  select s.*, g.fails,
         f.pending + case when s.before_total is null and s.after_total is null and not g.fails
                          then s.amount_cents else 0 end
  from f join s on s.card_id = f.card_id and s.n = f.n + 1,
  lateral (select coalesce(s.amount_cents + s.balance_cents
             + case when s.guard then f.pending else 0 end >= s.limit_cents, false) as fails) g),
running as (
  select transaction_id, card_id,
         coalesce(before_total,
                  case when fails then 'Total balance exceeds credit limit' end,
                  after_total) as decline_reason,
         pending / 100 as pending_balance
  from f)"""

RUNNING_OUT = """
select transaction_id, card_id,
       case when decline_reason is null then 'pending' else 'declined' end as status,
       decline_reason, pending_balance
from running"""

STREAM = """
stream as (
  select t.transaction_id, t.card_id, strftime(t.ts, '%d-%m-%Y %H:%M:%S') as timestamp, t.amount,
         t.location, coalesce(u.pending_balance, 0.0) as pending_balance,
         coalesce(u.status, '') as status
  from tx t left join updates u on t.transaction_id = u.transaction_id)"""

LATEST = """
latest as (
  select card_id, pending_balance from (
    select card_id, pending_balance,
           row_number() over (partition by card_id order by transaction_id desc) as n
    from updates) where n = 1)"""

ROLLED = """
rolled as (
  select c.card_id, c.customer_id, c.credit_limit,
         (cast(round(c.current_balance * 100) as bigint)
          + coalesce(cast(round(l.pending_balance * 100) as bigint), 0)) / 100 as current_balance
  from cards c left join latest l on c.card_id = l.card_id)"""


# The old balance goes through a 32-bit float.
ROLLED_FLOAT = """
rolled as (
  select c.card_id, c.customer_id, c.credit_limit,
         cast(cast(c.current_balance as float) as double) + coalesce(l.pending_balance, 0.0) as current_balance
  from cards c left join latest l on c.card_id = l.card_id)"""


def usage(cards: str) -> str:
    return f"""
usage as (
  select customer_id,
         cast(sum(cast(round(current_balance * 100) as bigint)) as bigint)
         / nullif(cast(sum(cast(round(credit_limit * 100) as bigint)) as bigint), 0)
         * 100 as usage_percent
  from {cards} group by customer_id)"""


def band(x: str) -> str:
    return f"""case when {x} <= 10 then 15 when {x} <= 20 then 10 when {x} <= 30 then 5
              when {x} <= 50 then -5 when {x} <= 70 then -15 when {x} > 70 then -25 end"""


CHANGES = f"""
changes as (
  select u.customer_id, u.usage_percent, coalesce({band('u.usage_percent')}, 0) as credit_score_change
  from usage u join customers c on u.customer_id = c.customer_id),
rescored as (
  select c.customer_id, c.name, c.address,
         c.credit_score + coalesce(h.credit_score_change, 0) as credit_score,
         coalesce(h.credit_score_change, 0) as credit_score_change
  from customers c left join changes h on c.customer_id = h.customer_id)"""


def cut(limit: str, change: str) -> str:
    return f"""case when {change} >= 0 then {limit}
            when {change} <= -20 then round_even({limit} * 0.85, -2)
            when {change} <= -10 then round_even({limit} * 0.9, -2)
            else round_even({limit} * 0.95, -2) end"""


def limited(cards: str) -> str:
    return f"""
select c.card_id, c.customer_id, c.current_balance,
       {cut('c.credit_limit', 'coalesce(r.credit_score_change, 0)')} as credit_limit
from {cards} c left join rescored r on c.customer_id = r.customer_id"""


RESENT = """
sent as (
  select transaction_id, card_id, ts, amount from tx
  union all
  select transaction_id, card_id, ts + interval 1 day, amount - 1 from tx
  where transaction_type = 'refund')"""


def _with(*parts: str, recursive: bool = False) -> str:
    *ctes, last = parts
    return f"with {'recursive ' if recursive else ''}" + ",".join(ctes) + "\n" + last


_BASE = (CARDS, CUSTOMERS, TX)
_RULES = (*_BASE, joined(), RULES)
_UPDATES = (*_RULES, VERDICTS, UPDATES)
_UPDATES_OUT = "select * from updates"
_BATCH = (*_UPDATES, STREAM, LATEST, ROLLED, usage("rolled"), CHANGES)
_HOT = (*_BASE, CORPORATE_TX, CORPORATE_CARDS, joined("corporate_tx", "corporate_cards"), RULES)
_RUNNING = _with(*_RULES, RUNNING, RUNNING_OUT, recursive=True)
_APPROVED = """select transaction_id, card_id, timestamp, amount, pending_balance,
    case when status = 'pending' then 'approved' else status end as status from stream"""
_RESCORED = "select customer_id, name, address, credit_score from rescored"
_GOOD_LINE = "transaction_type <> 'refund' and amount >= 20000"

ORACLE: dict[str, str] = {
    "blank_to_null": _with(
        TX,
        """select transaction_id,
           cast(nullif(trim(case when transaction_type = 'refund' then ' ' || card_id else '  ' end), '')
                as bigint) as related_transaction_id from tx""",
    ),
    "numeric_id": _with(
        TX, "select 'batch:' || transaction_id as prefixed_id, transaction_id as id_number from tx"
    ),
    "replay_order": _with(
        TX,
        """select transaction_id, cast(cast(ts as date) as varchar) as arrival_day,
           cast(cast(ts as date) as varchar) as parsed_day,
           strftime(ts, '%Y-%m-%d %H:%M:%S') as message_time,
           row_number() over (partition by cast(ts as date) order by transaction_id) as position from tx""",
    ),
    "json_roundtrip": _with(
        TX,
        """select transaction_id as txn_id, card_id, merchant_name,
           strftime(ts, '%Y-%m-%d %H:%M:%S') as timestamp, amount, location, transaction_type
           from tx""",
    ),
    "dedupe_first": _with(
        TX,
        RESENT,
        """select transaction_id, card_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as sent_at, amount from (
             select *, row_number() over (partition by transaction_id order by cast(ts as date)) as n
             from sent) where n = 1""",
    ),
    "distinct_count": _with(
        TX, RESENT, "select count(distinct transaction_id) as n_distinct from sent"
    ),
    "duplicate_ids": _with(
        TX,
        RESENT,
        "select transaction_id, count(*) as n_rows from sent group by 1 having count(*) > 1",
    ),
    "lookup_join": _with(
        *_BASE,
        joined(),
        """select transaction_id, card_id, customer_id, limit_cents / 100 as credit_limit,
           balance_cents / 100 as current_balance, home_zip from j""",
    ),
    "check_single_amount": _with(
        *_RULES, "select transaction_id, coalesce(before_total, 'passes') as verdict from r"
    ),
    "check_total_limit": _with(*_RULES, "select transaction_id, total_fails from r"),
    "check_address": _with(
        *_BASE, joined(), "select transaction_id, home_zip is null as address_missing from j"
    ),
    "same_region": _with(
        *_BASE,
        joined(),
        """select transaction_id, merchant_zip, home_zip,
           coalesce(length(home_zip) >= 5 and length(merchant_zip) >= 5
                    and left(home_zip, 1) = left(merchant_zip, 1), false) as same_region from j""",
    ),
    "unprocessable": _with(
        TX,
        """select transaction_id, card_id % 2 <> 0 as amount_missing from tx
           where transaction_type = 'refund'""",
    ),
    "validate": _with(
        *_RULES,
        VERDICTS,
        """select transaction_id, card_id, decline_reason,
           case when decline_reason is null then 'pending' else 'declined' end as status from v""",
    ),
    "earlier_smaller_id": _with(
        TX,
        """select transaction_id, card_id, coalesce(min(transaction_id) over (
             partition by card_id order by cast(ts as date), transaction_id
             rows between unbounded preceding and 1 preceding) < transaction_id, false) as has_earlier
           from tx""",
    ),
    "running_pending": _with(*_UPDATES, _UPDATES_OUT),
    "running_pending_hot_card": _with(*_HOT, VERDICTS, UPDATES, _UPDATES_OUT),
    "authorize_running": _RUNNING,
    "authorize_running_hot_card": _with(*_HOT, RUNNING, RUNNING_OUT, recursive=True),
    "overlay_transactions": _with(
        *_BASE, joined(where=f"t.ts < timestamp '{STREAM_STOPPED}'"), RULES, VERDICTS, UPDATES, STREAM,
        "select * from stream",
    ),
    "format_timestamp": _with(
        TX, "select transaction_id, strftime(ts, '%d-%m-%Y %H:%M:%S') as timestamp from tx"
    ),
    "approve_pending": _with(
        *_UPDATES,
        """select transaction_id, pending_balance,
           case when status = 'pending' then 'approved' else status end as status from updates""",
    ),
    "latest_pending": _with(*_UPDATES, LATEST, "select * from latest"),
    "roll_forward_balances": _with(*_UPDATES, LATEST, ROLLED, "select * from rolled"),
    "roll_forward_balances_float": _with(
        *_UPDATES,
        LATEST,
        """select c.card_id, c.customer_id, c.credit_limit,
           cast(cast(c.current_balance + cast(0.37 as double) as float) as double)
           + coalesce(l.pending_balance, 0.0) as current_balance
           from cards c left join latest l on c.card_id = l.card_id""",
    ),
    "credit_usage": _with(CARDS, usage("cards"), "select * from usage"),
    "credit_usage_large": _with(CARDS, LARGE_CARDS, usage("large_cards"), "select * from usage"),
    "roll_forward_balances_large": _with(
        *_UPDATES, LATEST, LARGE_CARDS, ROLLED.replace("from cards", "from large_cards"), "select * from rolled"
    ),
    "validate_large": _with(
        *_BASE, LARGE_CARDS, LARGE_TX, joined("large_tx", "large_cards"), RULES, VERDICTS,
        """select transaction_id, card_id,
             case when decline_reason is null then 'pending' else 'declined' end as status, decline_reason from v""",
    ),
    "score_changes": _with(
        CARDS,
        CUSTOMERS,
        usage("cards"),
        CHANGES,
        """select h.customer_id, h.usage_percent, h.credit_score_change, r.credit_score
           from changes h join rescored r on h.customer_id = r.customer_id""",
    ),
    "score_bands": _with(
        CARDS, f"select card_id, {band('((card_id % 1601) / 20)')} as credit_score_change from cards"
    ),
    "rescore_customers": _with(CARDS, CUSTOMERS, usage("cards"), CHANGES, "select * from rescored"),
    "limit_cuts": _with(
        CARDS,
        f"""select card_id, cast(card_id % 9 * 5 - 25 as integer) as credit_score_change,
            {cut('credit_limit', '(card_id % 9 * 5 - 25)')} as credit_limit from cards""",
    ),
    "adjust_limits": _with(CARDS, CUSTOMERS, usage("cards"), CHANGES, limited("cards")),
    "batch_transactions": _with(*_UPDATES, STREAM, _APPROVED),
    "batch_cards": _with(*_BATCH, limited("rolled")),
    "batch_customers": _with(*_BATCH, _RESCORED),
    "stream_authorize": _with(*_UPDATES, _UPDATES_OUT),
    "stream_authorize_running": _RUNNING,
    "stream_out_of_order": _with(
        *_BASE, joined(arrival="t.transaction_id % 7"), RULES, RUNNING, RUNNING_OUT, recursive=True
    ),
    "stream_restarted": _with(*_UPDATES, _UPDATES_OUT),
    "stream_bucketed": _RUNNING,
    "stream_merged": _with(*_UPDATES, STREAM, "select * from stream"),
    "stream_hot_card": _with(*_HOT, RUNNING, RUNNING_OUT, recursive=True),
    "stream_table": _with(*_UPDATES, STREAM, "select * from stream"),
    "stream_counts": _with(
        TX,
        """select n + refunds as n_got, unfit + unfit_refunds as n_aside,
             refunds - unfit_refunds as n_copies, n - unfit as n_checked from (
           select count(*) as n, count(*) filter (transaction_type = 'refund') as refunds,
             count(*) filter (transaction_id % 11 = 0) as unfit,
             count(*) filter (transaction_id % 11 = 0 and transaction_type = 'refund') as unfit_refunds
           from tx)""",
    ),
    "stream_quarantine": _with(
        TX,
        """select case when transaction_id % 5 <> 0 then transaction_id end as transaction_id, card_id,
           case transaction_id % 5 when 1 then null when 2 then cast('infinity' as double)
             else amount end as amount,
           case transaction_id % 5 when 0 then 'no transaction id' when 1 then 'no amount'
             else 'amount is not a number that fits' end as cause
           from tx where transaction_id % 5 < 3""",
    ),
    "quarantine": _with(
        CARDS,
        TX,
        """select * from (
             select t.card_id, t.merchant_name,
               case when t.transaction_id % 13 = 1 then 'no transaction id'
                    when t.transaction_id % 13 = 2 then 'no time'
                    when t.transaction_id % 13 = 3 then 'no amount'
                    when t.transaction_id % 13 between 4 and 6 then 'amount is not a number that fits'
                    when c.card_id % 7 = 0 then 'card without limit or balance' end as cause
             from tx t left join cards c on t.card_id = c.card_id) where cause is not null""",
    ),
    "whole_run_cards": _with(*_BATCH, limited("rolled")),
    "whole_run_customers": _with(
        *_UPDATES, LATEST, ROLLED_FLOAT, usage("rolled"), CHANGES,
        _RESCORED,
    ),
    "nightly_transactions": _with(*_UPDATES, STREAM, _APPROVED),
    "nightly_cards": _with(*_BATCH, limited("rolled")),
    "nightly_customers": _with(*_BATCH, _RESCORED),
    "published_together": _with(
        *_BATCH,
        f"""select l.*, r.credit_score from ({limited("rolled")}) l
            left join rescored r on r.customer_id = l.customer_id""",
    ),
    "load_and_publish": _with(
        CUSTOMERS,
        """select customer_id, address, credit_score,
           name || case when customer_id % 3 = 0 then chr(10) || '"second", line' else '' end as name
           from customers""",
    ),
    "sorted_results": _with(
        *_BASE,
        """select 'stream_transactions' as result, count(*) as n_rows, 0 as n_misplaced from tx
           union all select 'batch_transactions', count(*), 0 from tx
           union all select 'cards_updated', count(*), 0 from cards
           union all select 'customers_updated', count(*), 0 from customers""",
    ),
    "csv_line_breaks": _with(
        *_UPDATES, STREAM,
        """select s.transaction_id, s.card_id, s.timestamp, s.amount, s.pending_balance, s.status,
             t.merchant_name || case when t.transaction_id % 5 = 0 then chr(10) || '"a, b"' || chr(10) else '' end
               as merchant_name
           from stream s join tx t on s.transaction_id = t.transaction_id""",
    ),
    "csv_roundtrip": _with(CUSTOMERS, "select *, cast(null as double) as annual_income from customers"),
    "csv_skip_bad_rows": _with(
        TX,
        f"""select transaction_id, card_id, merchant_name, transaction_type from tx
            where {_GOOD_LINE}""",
    ),
    "csv_skipped_lines": _with(
        TX,
        f"""select transaction_id || ',' || card_id || ',' || merchant_name
            || case when transaction_type = 'refund' then ',refund,extra' else '' end as line
            from tx where not ({_GOOD_LINE})""",
    ),
}
