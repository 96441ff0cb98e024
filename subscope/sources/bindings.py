"""Raw CRM and PSP tables derived from the driver's TPC-H-like tables.

The test data holds no CRM tables, so each raw table is a projection of one of the given
tables, with the dirt the cleaning rules exist for: padded, blank and missing keys, mixed
case, soft deletes, orphans. The expressions use only what Spark SQL and DuckDB share, so
the oracle derives its inputs from the same text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from subscope.schemas import RAW_DDL, raw_schema

SYNC = "cast('2024-02-01 00:00:00' as timestamp)"
ITEM = (
    "concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey, '-', "
    "cast(cast(l_shipdate as date) as string), '-', "
    "cast(floor(l_extendedprice * 100 + 0.5) as bigint))"
)
SHIP = "cast(l_shipdate as date)"
# no subscription ends or changes later, so that the latest quarter is one with subscriptions and events
LAST_CHANGE = "2001-11-18"
ORDERED = "cast(o_orderdate as date)"


@dataclass(frozen=True)
class Binding:
    source: str
    columns: dict[str, str]
    distinct: tuple[str, ...] = ()


def _fk(prefix: str, value: str, k: str, orphan: int = 0) -> str:
    """A dirty foreign key: padded, blank, missing, and orphaned every ``orphan`` rows."""
    lost = f"when {k} % {orphan} = {orphan - 1} then concat('{prefix}-x', {value}) " if orphan else ""
    return (
        f"case when {k} % 29 = 3 then cast(null as string) when {k} % 31 = 4 then '   ' {lost}"
        f"when {k} % 7 = 1 then concat('{prefix}-', {value}, '    ') "
        f"else concat('{prefix}-', {value}) end"
    )


def _deleted(k: str) -> str:
    return (
        f"case when {k} % 41 = 7 then true when {k} % 43 = 5 then cast(null as boolean) "
        "else false end"
    )


def _pick(k: str, *values: str | None) -> str:
    """One of the values by ``k`` modulo their number; None is NULL."""
    whens = " ".join(
        f"when {i} then " + ("cast(null as string)" if v is None else f"'{v}'")
        for i, v in enumerate(values)
    )
    return f"case {k} % {len(values)} {whens} end"


def _day(base: str, offset: str) -> str:
    return f"({base} + cast({offset} as int))"


def _at(day: str, hours: str) -> str:
    return f"(cast({day} as timestamp) + ({hours}) * interval '1' hour)"


EPOCH = "date '1995-01-01'"


def _crm(
    source: str, pk: str, prefix: str, k: str, name: str, entered: str, modified: str, /, *,
    deleted: str | None = None, distinct: tuple[str, ...] = (),
    **columns: str,
) -> Binding:
    head = {
        "id": f"concat('{prefix}-', {pk})", "name": name, "date_entered": entered,
        "date_modified": modified, "deleted": _deleted(k) if deleted is None else deleted,
    }
    tail = {"_etl_synced_at": SYNC, "_etl_source_system": "'crm'"}
    return Binding(source, {**head, **columns, **tail}, distinct)


def _psp(source: str, pk: str, prefix: str, /, **columns: str) -> Binding:
    tail = {"_etl_synced_at": SYNC, "_etl_source_system": "'psp'"}
    return Binding(source, {"id": f"concat('{prefix}-', {pk})", **columns, **tail})


_r, _n, _s, _cu, _p, _o, _e = (
    "r_regionkey", "n_nationkey", "s_suppkey", "c_custkey", "p_partkey", "o_orderkey", "event_id"
)
_lp, _lo, _ls = "l_partkey", "l_orderkey", "l_suppkey"
_mix = f"({_lo} + {_lp})"
NULL_TS = "cast(null as timestamp)"

BINDINGS: dict[str, Binding] = {
    "crm_channel_partners": _crm(
        "region", _r, "cp", _r, "concat('  ', r_name, ' ')",
        _at(EPOCH, _r), _at(EPOCH, f"{_r} + 24"),
        deleted=f"case when {_r} = 4 then cast(null as boolean) else false end",
        legal_name="concat(r_name, ' LLC  ')",
        channel_partner_type=_pick(_r, " Retailer ", "ecommerce"),
        vat_trn_number=f"concat('300', {_r})",
        country_id=f"concat('ct-', {_r}, '  ')",
        channel_partner_uid=f"concat(' u', {_r})",
        status=_pick(_r, "Active", "ACTIVE ", None),
    ),
    "crm_programs": _crm(
        "nation", _n, "pg", _n,
        f"concat(' ', n_name, case {_n} % 6 when 2 then ' FNF' when 4 then ' fnf staff' else '' end)",
        _at(_day(EPOCH, f"{_n} * 10"), _n), _at(_day(EPOCH, f"{_n} * 10 + 3"), _n),
        deleted=f"case when {_n} = 23 then true else false end",
        program_start_date="'1995-01-01'", program_end_date="'2005-01-01'",
        program_status=_pick(_n, "ACTIVE", " active ", "ACTIVE", "DISABLED", None),
        channel_partner_id=(
            f"case {_n} when 11 then cast(null as string) when 17 then '  ' "
            f"else concat('cp-', {_n} % 5, '  ') end"
        ),
        program_uid=f"concat('p', {_n})",
        payment_methods_limit=f"cast({_n} % 4 as int)",
        subscription_limit=(
            f"case {_n} % 6 when 0 then cast(null as int) when 1 then cast({_n} as int) "
            f"when 2 then 0 else cast({_n} * 25 as int) end"
        ),
    ),
    "crm_corporate_company": _crm(
        "supplier", _s, "co", _s, "concat(s_name, '  ')",
        _at(_day(EPOCH, f"{_s} % 900"), "8"), _at(_day(EPOCH, f"{_s} % 900 + 5"), "9"),
        corporate_company_type=_pick(_s, "Employer", " PARTNER", None),
        allowed_email_domains=f"concat('d', {_s}, '.example ')",
        status=_pick(_s, "Active", "inactive ", None),
        channel_partners_id=_fk("cp", f"{_s} % 6", _s),
    ),
    "crm_accounts": _crm(
        "customer", _cu, "ac", _cu, "concat(' ', c_name)",
        _at(_day(EPOCH, f"{_cu} % 1500"), f"{_cu} % 24"),
        _at(_day(EPOCH, f"{_cu} % 1500 + 30"), f"{_cu} % 24"),
        phone_number=f"concat(' 0500', {_cu}, ' ')",
        national_id=f"concat('1', {_cu}, '  ')",
        zoho_customer_id=f"case {_cu} % 4 when 0 then '  ' else concat('z', {_cu}) end",
        mobile_number=f"concat('05', {_cu})",
        customer_status=_pick(_cu, "Active", " BLOCKED", None),
        programs_customer_id=_fk("pg", f"{_cu} % 25", _cu),
        channel_partner_id=_fk("cp", f"{_cu} % 5", f"({_cu} + 11)"),
        is_mobile_verified=_pick(_cu, " YES ", "no", None, "Yes", "", "yes"),
        customer_uid=f"concat('c', {_cu}, ' ')",
        personal_email_address=f"concat('c', {_cu}, '@example.com ')",
        corporate_company_id=(
            f"case when {_cu} % 3 = 0 then cast(null as string) when {_cu} % 11 = 0 then '  ' "
            f"when {_cu} % 13 = 2 then concat('co-x', {_cu}) "
            f"when {_cu} % 4 = 1 then 'co-1  ' else concat('co-', {_cu} % 90, ' ') end"
        ),
        customer_verification_at=f"case when {_cu} % 5 = 0 then {NULL_TS} else {_at(EPOCH, _cu)} end",
        nafath_verified_at=f"case when {_cu} % 4 = 0 then {_at(EPOCH, f'{_cu} + 2')} else {NULL_TS} end",
        nafath_verified=(
            f"case {_cu} % 4 when 0 then true when 1 then false when 2 then cast(null as boolean) "
            "else true end"
        ),
    ),
    "crm_countries": _crm(
        "nation", _n, "ct", _n, "concat(n_name, '  ')", _at(EPOCH, _n), _at(EPOCH, f"{_n} + 1"),
        country_code=f"concat('C', {_n}, ' ')", country_currency="' SAR '",
        vat_rate=f"cast({_n} % 3 * 5 as int)", zoho_tax_id=f"concat('t', {_n})",
    ),
    "crm_addresses": _crm(
        "customer", _cu, "ad", _cu, f"concat('home ', {_cu})",
        _at(_day(EPOCH, f"{_cu} % 1500"), "1"), _at(_day(EPOCH, f"{_cu} % 1500"), "2"),
        addresses_city="concat(' ', c_mktsegment)", addresses_country="'SA '",
        addresses_street=f"concat('st ', {_cu})", addresses_type=_pick(_cu, " Home", "OFFICE", None),
        addresses_area="'north '", customer_id=_fk("ac", _cu, _cu, 17),
        addresses_default_address=f"case when {_cu} % 2 = 0 then true else false end",
        district=f"concat(' d', {_cu} % 10)", postal_code=f"concat({_cu} % 100, ' ')",
    ),
    "crm_master_skus": _crm(
        "part", _p, "ms", _p, "concat(p_name, ' ')",
        _at(_day(EPOCH, f"{_p} % 300"), "0"), _at(_day(EPOCH, f"{_p} % 300"), "5"),
        brand=f"case when {_p} % 50 in (9, 10) then cast(null as string) else concat(p_brand, '  ') end",
        model=f"case when {_p} % 50 = 9 then cast(null as string) else concat(' ', p_type) end",
        memory=f"case when {_p} % 50 = 9 then cast(null as string) else concat({_p} % 4 * 128, 'GB') end",
        color=(
            f"case when {_p} % 50 = 9 then cast(null as string) "
            f"else {_pick(_p, ' black', 'silver ', 'gold')} end"
        ),
        category=_pick(_p, "Phone", " TABLET ", "watch"),
        sku_master_uid=f"concat('m', {_p}, ' ')",
    ),
    "crm_program_skus": _crm(
        "part", _p, "ps", f"({_p} + 1)", "concat(' ', p_name)",
        _at(_day(EPOCH, f"{_p} % 300"), "3"), _at(_day(EPOCH, f"{_p} % 300"), "6"),
        barcode=f"concat('b', {_p}, ' ')", launch_rrp="p_retailprice",
        master_skus_id=_fk("ms", _p, _p, 17),
        program_skus_type=_pick(_p, "Device", " ACCESSORY"),
        category=_pick(_p, "Phone", " Tablet ", None),
        program_skus_uid=f"concat('s', {_p})",
    ),
    "crm_cp_skus": _crm(
        "lineitem", f"{_lp}, '-', {_ls}", "cs", f"({_lp} + {_ls})",
        f"concat('cp sku ', {_lp}, ' ')",
        _at(_day(EPOCH, f"{_lp} % 500"), "1"), _at(_day(EPOCH, f"{_lp} % 500"), "2"),
        distinct=(_lp, _ls),
        purchase_price=f"cast({_lp} % 900 as double) + 0.25",
        category=_pick(_lp, "Phone ", "TABLET", None),
        channel_partner_id=_fk("cp", f"{_ls} % 5", f"({_lp} + {_ls})"),
        program_sku_id=(
            f"case when ({_lp} + {_ls}) % 3 = 0 then cast(null as string) "
            f"when ({_lp} + {_ls}) % 19 = 1 then concat('ps-x', {_lp}) "
            f"else concat('ps-', {_lp}, ' ') end"
        ),
        master_sku_id=(
            f"case when ({_lp} + {_ls}) % 4 = 0 then cast(null as string) else concat('ms-', {_lp}) end"
        ),
        cp_skus_uid=f"concat('k', {_lp}, '-', {_ls}, ' ')",
        cp_item_code=f"concat(' i', {_lp})",
    ),
    "crm_orders": _crm(
        "orders", _o, "or", _o, f"concat('ORD-', {_o}, ' ')",
        _at(ORDERED, f"{_o} % 24"), _at(ORDERED, f"{_o} % 24 + 72"),
        order_status=(
            f"case when {_o} % 37 = 11 then cast(null as string) "
            "when o_orderstatus = 'P' then 'Waiting_For_Delivery' "
            "when o_orderstatus = 'O' then ' delivered' "
            "when o_orderpriority = '1-URGENT' then 'Cancelled ' "
            "when o_orderpriority = '2-HIGH' then 'rejected' "
            "when o_orderpriority = '3-MEDIUM' then ' EXPIRED ' else 'Delivered' end"
        ),
        customer_id=_fk("ac", "o_custkey", _o, 10),
        # one program takes two thirds of the orders
        programs_order_id=_fk("pg", f"case when {_o} % 3 <> 0 then 1 else o_custkey % 25 end", _o),
        payment_method_id=_fk("pm", "o_custkey", f"({_o} + 5)"),
        order_type=(
            "case when o_orderpriority = '5-LOW' then ' Pre-Order' "
            "when o_orderpriority = '2-HIGH' then cast(null as string) "
            f"when {_o} % 50 = 0 then '  ' else 'Order ' end"
        ),
        sales_channel=_pick(_o, " Online", "STORE", None),
        delivered_on=(
            f"case when o_orderstatus = 'P' or {_o} % 6 = 0 then cast(null as date) "
            f"else {_day(ORDERED, f'{_o} % 15')} end"
        ),
        total_amount_incl_vat="o_totalprice",
        total_discount_amount=f"cast({_o} % 50 as double) + 0.5",
        total_gmv_amount_incl_vat=(
            f"case when {_o} % 13 = 0 then cast(null as double) else o_totalprice end"
        ),
    ),
    "crm_order_items": _crm(
        "lineitem", ITEM, "it", _mix, f"concat('item ', {_lp})",
        _at(SHIP, f"{_lp} % 24"), _at(SHIP, f"{_lp} % 24 + 48"),
        quantity="cast(l_quantity as int)",
        product_type=_pick(_lp, " Device", "ACCESSORY", None),
        order_id=_fk("or", _lo, _mix, 23),
        program_sku_id=(
            f"case when l_linenumber % 3 = 0 then concat('ps-', {_lp}, '  ') "
            f"when l_linenumber % 3 = 2 and {_lp} % 5 = 0 then concat('ps-x', {_lp}) "
            f"when {_lp} % 9 = 0 then '  ' else cast(null as string) end"
        ),
        cp_sku_id=(
            f"case when l_linenumber % 3 = 1 then concat('cs-', {_lp}, '-', {_ls}, '  ') "
            f"when l_linenumber % 3 = 2 and {_lp} % 7 = 0 then concat('cs-', {_lp}, '-', {_ls}) "
            "else cast(null as string) end"
        ),
        unit_price_vat_inclusive=f"cast({_lp} % 1000 as double) + 0.75",
        total_price_vat_inclusive="l_extendedprice",
        device_purchase_price_vat_inclusive=(
            f"case when {_lp} % 8 = 0 then cast(null as double) else floor(l_extendedprice) + 0.5 end"
        ),
        customer_id=_fk("ac", f"{_ls} * 3", _mix),
        discount_amount="floor(l_extendedprice * l_discount) + 0.25",
        imei_1=f"concat('35', {_lp}, ' ')", serial_no=f"concat(' sn', {_lp})",
        order_line_item_type=_pick(_lp, "Device ", " ADDON"),
    ),
    "crm_subscriptions": _crm(
        "lineitem", ITEM, "su", _mix, f"concat('sub ', {_lo})",
        _at(SHIP, f"{_lp} % 24 - 48"),
        f"least({_at(_day(SHIP, f'{_lp} % 300'), f'{_lp} % 24')}, cast('{LAST_CHANGE} 00:00:00' as timestamp))",
        subscription_uid=f"concat('S', {_lo}, ' ')",
        subscription_status=(
            f"case when {_lp} % 37 = 0 then cast(null as string) "
            "when l_returnflag = 'R' then 'Cancelled' "
            f"when l_returnflag = 'A' then {_pick(_lp, 'Upgraded', 'KIFED', ' auto_kifed', 'Waiting_For_Delivery', ' Active')} "
            "else 'Active' end"
        ),
        service_start_date=f"case when {_lp} % 13 = 0 then cast(null as date) else {SHIP} end",
        service_end_date=(
            f"case when l_returnflag = 'R' and {_lp} % 4 <> 0 then least({_day(SHIP, f'{_lp} % 400')}, cast('{LAST_CHANGE}' as date)) "
            "else cast(null as date) end"
        ),
        subscription_close_date=(
            f"case when {_lp} % 3 = 0 then least({_day(SHIP, f'{_lp} % 230 - 60')}, cast('{LAST_CHANGE}' as date)) "
            "else cast(null as date) end"
        ),
        order_item_id=f"concat('it-', {ITEM}, '  ')",
        subscription_pricing_id=_fk("pr", _lp, _mix, 19),
        channel_partner_id=_fk("cp", f"{_ls} % 5", f"({_lp} + 2)"),
        order_id=_fk("or", _lo, f"({_mix} + 9)", 27),
        upgraded_subscription_id=f"case when {_lp} % 20 = 0 then concat('su-', {ITEM}) else '  ' end",
        product_type=_pick(_lp, "Device", None),
        customer_id=_fk("ac", f"{_ls} * 3", f"({_mix} + 1)"),
    ),
    "crm_subscription_pricing": _crm(
        "part", _p, "pr", f"({_p} + 3)", f"concat('price ', {_p}, ' ')",
        _at(_day(EPOCH, f"{_p} % 300"), "1"), _at(_day(EPOCH, f"{_p} % 300"), "2"),
        monthly_subscription_amount=(
            f"case when {_p} % 10 = 0 then cast(null as double) else cast({_p} % 300 as double) + 49.5 end"
        ),
        subscription_pricing_status=_pick(_p, "Active ", "inactive", None),
        subscription_pricing_start_date=EPOCH,
        subscription_pricing_end_date=_day(EPOCH, f"{_p} % 3000"),
        program_sku_id=_fk("ps", _p, _p),
        subscription_durations_id=_fk("du", "p_size", _p, 21),
    ),
    "crm_subscription_durations": _crm(
        "part", "p_size", "du", "p_size", "concat('term ', p_size)",
        _at(EPOCH, "p_size"), _at(EPOCH, "p_size + 1"), distinct=("p_size",),
        duration="concat(' ', p_size, ' ')",
        duration_status=_pick("p_size", " Active", "inactive", None),
        duration_start_date=EPOCH, duration_end_date="cast(null as date)",
        programs_id=_fk("pg", "p_size % 25", "p_size"),
        channel_partners_id=_fk("cp", "p_size % 5", "(p_size + 4)"),
    ),
    "crm_devices": _crm(
        "lineitem", ITEM, "dv", f"({_mix} + 2)", f"concat('device ', {_lp})",
        _at(SHIP, "1"), _at(SHIP, "2"),
        serial_number=f"concat(' SN', {_lo}, ' ')",
        purchase_price="cast(l_extendedprice as decimal(18,4))",
        purchase_date=f"case when {_lp} % 25 = 0 then cast(null as date) else {_day(SHIP, '-10')} end",
        imei2="'  '", brand=f"concat('Brand#', {_lp} % 25, ' ')", model=f"concat(' M', {_lp} % 40)",
        device_memory=f"concat({_lp} % 4 * 128, 'GB ')", color=_pick(_lp, " black", "silver"),
        delivery_date=f"case when {_lp} % 6 = 0 then cast(null as date) else {SHIP} end",
        devices_type=_pick(_lp, " Phone", "TABLET"),
        order_item_id=(
            f"case when {_lp} % 27 = 0 then concat('it-x', {ITEM}) when {_lp} % 28 = 0 then ' ' "
            f"else concat('it-', {ITEM}, '   ') end"
        ),
        device_condition=_pick(_ls, "New ", " REFURBISHED", None),
        program_sku_id=_fk("ps", _lp, _mix), imei1=f"concat('35', {_lo}, ' ')",
    ),
    "crm_devices_journey": _crm(
        "lineitem", ITEM, "dj", f"({_mix} + 3)", f"concat('move ', {_lp})",
        _at(_day(SHIP, "4"), f"{_lp} % 24"), _at(_day(SHIP, "5"), "0"),
        device_movement=_pick(_lp, " Returned", "SHIPPED", None),
        movement_date=_day(SHIP, f"{_lp} % 30"),
        devices_journey_device_id=_fk("dv", ITEM, _mix, 15),
    ),
    "crm_payments": _crm(
        "lineitem", ITEM, "py", f"({_mix} + 4)", f"concat('pay ', {_lp})",
        _at(SHIP, f"{_lp} % 24"), _at(SHIP, f"{_lp} % 24 + 5"),
        payment_status=_pick(
            _mix, "Paid ", "paid", " failed", "Refunded", "not_invoiced", "CANCELLED", None
        ),
        payment_due_date=_at(_day(SHIP, "30"), "0"),
        payment_amount_tax_inclusive=(
            f"case when {_lp} % 71 = 0 then cast(null as decimal(18,4)) "
            "else cast(l_extendedprice as decimal(18,4)) end"
        ),
        payment_type=(
            f"case when l_linenumber = 1 then ' Recurring' when {_lp} % 4 = 0 then cast(null as string) "
            "else 'one_time' end"
        ),
        payment_id=(
            f"case {_lp} % 5 when 0 then cast(null as string) when 1 then '   ' "
            f"else concat('pp-', {ITEM}, '  ') end"
        ),
        customer_payment_id=_fk("ac", f"{_ls} * 3", f"({_mix} + 6)", 33),
        subscription_payment_id=(
            f"case when l_linenumber = 1 then concat('su-', {ITEM}) else cast(null as string) end"
        ),
        order_id=_fk("or", _lo, f"({_mix} + 8)", 35),
        invoice_id=_fk("iv", _lo, f"({_mix} + 5)"),
        payment_timestamp=f"case when {_ls} % 3 = 0 then {NULL_TS} else {_at(SHIP, f'{_lp} % 60')} end",
        refund_amount=(
            f"case {_lp} % 4 when 0 then cast(null as double) when 1 then cast(0 as double) "
            "else floor(l_extendedprice) + 0.5 end"
        ),
        refund_status=_pick(_lp, "Approved ", None),
    ),
    "crm_payment_history": _crm(
        "lineitem", ITEM, "ph", f"({_mix} + 7)", f"concat('try ', {_lp})",
        _at(SHIP, f"{_lp} % 24"), _at(SHIP, f"{_lp} % 24 + 1"),
        payment_method_id=_fk("pm", f"{_ls} * 3", f"({_mix} + 3)"),
        error_code=_pick(_lp, "E1 ", None), error_reason=_pick(_lp, " declined", None),
        last_four=f"concat({_lp} % 10000, ' ')",
        expiry_month=f"cast({_lp} % 12 + 1 as int)", expiry_year=f"cast(1999 + {_lp} % 6 as int)",
        action=_pick(_lp, " Charge", "REFUND"),
        status=_pick(
            f"({_lo} + 2 * {_lp})", "Approved", "failed", " paid", "Paid", "success", None, "FAILED "
        ),
        funding_type=_pick(_ls, "Credit ", "debit"),
        attempted_at=f"case when {_lp} % 77 = 0 then {NULL_TS} else {_at(SHIP, f'{_lp} % 48')} end",
        payment_id=f"case when {_lp} % 39 = 0 then ' ' else concat('py-', {ITEM}, '  ') end",
        refund_id="'  '",
    ),
    "crm_payment_methods": _crm(
        "customer", _cu, "pm", f"({_cu} + 9)", f"concat('card ', {_cu})",
        _at(_day(EPOCH, f"{_cu} % 1500"), "3"), _at(_day(EPOCH, f"{_cu} % 1500"), "4"),
        status=_pick(_cu, "Active ", "enabled", "Blocked", None),
        is_default=f"case {_cu} % 3 when 0 then true when 1 then false else cast(null as boolean) end",
        type=_pick(_cu, " Card", "wallet"), ending_digits=f"concat({_cu} % 10000, ' ')",
        expiry_year=(
            f"case when {_cu} % 15 = 0 then cast(null as int) else cast(2000 + {_cu} % 4 as int) end"
        ),
        expiry_month=f"cast({_cu} % 13 + 1 as int)",
        customer_id=_fk("ac", _cu, _cu, 22),
        payment_method_brand=_pick(_cu, "VISA", " Mada", None),
        funding_type=_pick(_cu, "Credit", "DEBIT "),
    ),
    "crm_aos_invoices": _crm(
        "orders", _o, "iv", f"({_o} + 6)", f"concat('INV-', {_o}, ' ')",
        _at(_day(ORDERED, "1"), f"{_o} % 24"), _at(_day(ORDERED, "2"), "0"),
        billing_account_id=_fk("ac", "o_custkey", f"({_o} + 3)"),
        total_amount=(
            f"case when {_o} % 53 = 0 then cast(null as decimal(18,4)) "
            "else cast(o_totalprice as decimal(18,4)) end"
        ),
        invoice_date=f"case when {_o} % 8 = 0 then cast(null as date) else {_day(ORDERED, f'{_o} % 40')} end",
        settlement_date=f"case when {_o} % 16 = 0 then cast(null as date) else {_day(ORDERED, '45')} end",
        invoice_status=_pick(_o, "Paid", " paid", "unpaid", None, "Unpaid "),
        invoice_due_date=_day(ORDERED, "30"),
        vat_amount=f"cast({_o} % 400 as double) + 0.5",
        customer_id=_fk("ac", "o_custkey", f"({_o} + 13)", 25),
        channel_partner_id=_fk("cp", f"{_o} % 5", f"({_o} + 1)"),
        programs_id=_fk("pg", f"{_o} % 25", f"({_o} + 2)"),
        amount_ex_vat="floor(o_totalprice) + 0.25",
        zoho_invoice_number=f"concat('Z', {_o}, '  ')",
    ),
    "crm_invoice_line_items": _crm(
        "lineitem", ITEM, "il", f"({_mix} + 8)", f"concat('line ', {_lp})",
        _at(SHIP, "5"), _at(SHIP, "6"),
        amount="l_extendedprice", line_item_id=f"case when {_lp} % 2 = 0 then ' ' else concat('li-', {_lp}) end",
        quantity="cast(l_quantity as int)",
        amount_ex_vat="cast(floor(l_extendedprice) as decimal(18,4))",
        vat_amount=f"cast({_lp} % 90 as decimal(18,4))",
        total_inc_vat="cast(l_extendedprice as decimal(18,4))",
        invoice_line_item_id=_fk("iv", _lo, f"({_mix} + 4)", 26),
        subscriptions_id=(
            f"case when l_linenumber = 1 then concat('su-', {ITEM}, ' ') "
            f"when {_lp} % 9 = 0 then concat('su-x', {_lp}) else '  ' end"
        ),
        product_type=_pick(_lp, "Rental ", " DEVICE", None),
        order_item_id=f"concat('it-', {ITEM}, ' ')",
    ),
    "crm_credit_notes": _crm(
        "lineitem", ITEM, "cn", f"({_mix} + 1)", f"concat('CN ', {_lp})",
        f"case when {_lp} % 45 = 0 then {NULL_TS} else {_at(SHIP, f'{_lp} % 2400')} end",
        _at(SHIP, "9"),
        invoice_id=_fk("iv", _lo, f"({_mix} + 2)", 24),
        credit_note_zoho_url=f"concat(' https://example.com/', {_lp})",
        zoho_status=_pick(_lp, " Open", "CLOSED", None),
        zoho_credit_note_id=f"concat('zc', {_lp}, ' ')",
        credit_id=f"case when {_lp} % 3 = 0 then '  ' else concat('cr', {_lp}) end",
    ),
    "crm_api_logs": _crm(
        "events", _e, "al", _e, f"concat('call ', {_e})",
        "cast(ts as timestamp)", "(cast(ts as timestamp) + interval '1' hour)",
        parent_type=_pick(
            _e, " Channel_Partners", "orders", "subscriptions ", "accounts", "invoices", None, "ORDERS"
        ),
        parent_id=(
            f"case {_e} % 7 when 0 then concat('cp-', {_e} % 6, ' ') "
            "when 1 then concat('or-', user_id, '  ') when 2 then concat('su-', user_id) "
            f"when 3 then concat('ac-', user_id, ' ') when 6 then concat('or-', {_e} % 20000) "
            "else '  ' end"
        ),
        error_details=f"case when event_type = 'error' then concat(' code ', {_e} % 9) else cast(null as string) end",
        status=(
            "case when event_type = 'error' then ' Failure' "
            "when event_type = 'signup' then cast(null as string) else 'success' end"
        ),
        source="concat(' ', event_type)",
    ),
    "payments_payments": _psp(
        # payments the PSP knows under another key: their CRM payment finds none
        "lineitem", f"case when {_lp} % 7 = 0 then concat({ITEM}, '-own') else {ITEM} end", "pp",
        payment_type=_pick(_lp, " Recurring", "one_time"),
        amount=(
            f"case when {_lp} % 47 = 0 or {_lp} % 71 = 0 then cast(null as double) "
            f"when {_lp} % 6 = 0 then l_extendedprice + 1 else l_extendedprice end"
        ),
        due_date=_at(SHIP, "24"), subscriber_id=f"concat('sb-', {_ls})",
        subscription_id=f"concat('sp-', {_ls})",
        transaction_id=f"case when {_ls} % 9 = 0 then cast(null as string) else concat('tx-', {_lo}) end",
        payment_intent_id=f"concat('pi-', {_lo})", created_at=_at(SHIP, "2"), updated_at=_at(SHIP, "3"),
        deleted_at=f"case when {_lp} % 53 = 0 then {_at(SHIP, '4')} else {NULL_TS} end",
    ),
    "payments_transactions": _psp(
        "events", _e, "tx",
        payment_intent_id=f"case when {_e} % 12 = 0 then '  ' else concat('pi-', {_e}, ' ') end",
        process_status=(
            "case event_type when 'purchase' then ' Completed' when 'view' then 'completed' "
            "when 'error' then 'FAILED' when 'click' then 'Queued ' else cast(null as string) end"
        ),
        request_status=_pick(
            _e, "success", " Success ", "failed", "", None, "authorized", "internal_error", "voided"
        ),
        type=_pick(_e, "Charge ", " REFUND"),
        subscriber_id=f"case when {_e} % 18 = 0 then ' ' else concat('sb-', user_id, ' ') end",
        is_scheduled=f"case {_e} % 3 when 0 then true when 1 then false else cast(null as boolean) end",
        due_date="(cast(ts as timestamp) + interval '1' hour)",
        created_at="cast(ts as timestamp)", updated_at="cast(ts as timestamp)",
        _etl_deleted_at=f"case when {_e} % 61 = 0 then cast(ts as timestamp) else {NULL_TS} end",
    ),
    "payments_refunds": _psp(
        "orders", _o, "rf",
        refund_id=f"concat(' re', {_o})", payment_intent_id=f"case when {_o} % 5 = 0 then ' ' else concat('pi-', {_o}) end",
        amount=f"cast({_o} % 500 as int)", status=_pick(_o, "Approved", " approved ", "pending", None),
        currency=_pick(_o, "SAR ", "sar"), created_at=_at(ORDERED, "5"), updated_at=_at(ORDERED, "6"),
        _etl_deleted_at=f"case when {_o} % 31 = 0 then {_at(ORDERED, '7')} else {NULL_TS} end",
    ),
    "payments_subscribers": _psp(
        "customer", _cu, "sb",
        stripe_id=f"concat('cus_', {_cu}, ' ')",
        default_payment_method_id=f"case when {_cu} % 6 = 0 then '  ' else concat('pq-', {_cu}) end",
        disputed=f"case when {_cu} % 20 = 0 then true else false end",
        created_at=_at(_day(EPOCH, f"{_cu} % 900"), "1"), updated_at=_at(_day(EPOCH, f"{_cu} % 900"), "2"),
        deleted_at=f"case when {_cu} % 40 = 0 then {_at(EPOCH, '9')} else {NULL_TS} end",
        collectible=f"case {_cu} % 3 when 0 then true when 1 then false else cast(null as boolean) end",
    ),
    "payments_subscriptions": _psp(
        "customer", _cu, "sp",
        currency="' SAR'", locked=f"case when {_cu} % 9 = 0 then true else false end",
        subscriber_id=f"case when {_cu} % 14 = 0 then '  ' else concat('sb-', {_cu}, ' ') end",
        created_at=_at(_day(EPOCH, f"{_cu} % 900"), "3"), updated_at=_at(_day(EPOCH, f"{_cu} % 900"), "4"),
        deleted_at=f"case when {_cu} % 33 = 0 then {_at(EPOCH, '9')} else {NULL_TS} end",
    ),
    "payments_payment_methods": _psp(
        "customer", _cu, "pq",
        is_enabled=f"case {_cu} % 3 when 0 then true when 1 then false else cast(null as boolean) end",
        expiry_month=f"cast({_cu} % 12 + 1 as int)", expiry_year=f"cast(2000 + {_cu} % 5 as int)",
        payment_gateway=_pick(_cu, " Stripe", "HyperPay "), last4=f"concat({_cu} % 10000, ' ')",
        subscriber_id=f"case when {_cu} % 16 = 0 then '  ' else concat('sb-', {_cu}, ' ') end",
        created_at=_at(_day(EPOCH, f"{_cu} % 900"), "5"), updated_at=_at(_day(EPOCH, f"{_cu} % 900"), "6"),
        deleted_at=f"case when {_cu} % 27 = 0 then {_at(EPOCH, '9')} else {NULL_TS} end",
        expired=f"case {_cu} % 4 when 0 then true when 1 then cast(null as boolean) else false end",
    ),
}


# Schemas of the given tables: declared, so that no job runs to infer them.
GIVEN = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def bound_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One raw table, derived from the given tables under ``sf_dir``."""
    b = BINDINGS[table]
    base = spark.read.schema(GIVEN[b.source]).parquet(f"{sf_dir.rstrip('/')}/{b.source}.parquet")
    if b.distinct:
        base = base.select(*b.distinct).distinct()
    schema = raw_schema(table)
    return base.selectExpr(*[
        f"cast({b.columns[f.name]} as {f.dataType.simpleString()}) as `{f.name}`" for f in schema
    ])


def bound_raw(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    return lambda table: bound_table(spark, sf_dir, table)


def bound_sql(table: str) -> str:
    """The same derivation as a DuckDB select."""
    b = BINDINGS[table]
    base = b.source
    if b.distinct:
        base = f"(select distinct {', '.join(b.distinct)} from {b.source})"
    types = dict(c.strip().split(" ", 1) for c in RAW_DDL[table].split(", "))
    cols = ", ".join(f"cast({e} as {types[c]}) as {c}" for c, e in b.columns.items())
    return f"select {cols} from {base}"

