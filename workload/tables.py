"""Every staged, conformed and mart table as a query."""

from __future__ import annotations

from subscope.plans.warehouse import CONFORMED, MARTS, STAGED
from workload.base import query

# Inventory order of the models, which numbers them.
STAGED_IDS = (
    "stg_accounts stg_invoices stg_addresses stg_api_logs stg_channel_partners "
    "stg_corporate_companies stg_countries stg_cp_skus stg_credit_notes stg_devices "
    "stg_devices_journey stg_invoice_line_items stg_master_skus stg_order_items stg_orders "
    "stg_payment_history stg_payment_methods stg_payments stg_programs "
    "stg_subscription_durations stg_subscription_pricing stg_subscriptions stg_program_skus "
    "stg_psp_payment_methods stg_psp_payments stg_psp_refunds stg_psp_subscribers "
    "stg_psp_subscriptions stg_psp_transactions"
).split()

for _letter, _names in (("T", STAGED_IDS), ("I", list(CONFORMED)), ("K", list(MARTS))):
    for _i, _name in enumerate(_names, 1):
        query(_name, f"{_letter}{_i}")(lambda w, n=_name: w[n])

assert set(STAGED_IDS) == set(STAGED)
