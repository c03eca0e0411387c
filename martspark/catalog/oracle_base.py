"""DuckDB oracle text shared by all queries: binding, staging and common CTEs.

Every oracle is ``WITH <prelude>, <query ctes> <final select>``.  The prelude
derives the ERP sources from the driver views (FIXTURES.md §2) and the staging
models; DuckDB only binds the CTEs a query references.  Output conventions,
identical on the Spark side: money as double, counts as bigint, ratios rounded
half-up through decimal(28,8).
"""

from __future__ import annotations

from ..functions import labels as L
from ..sources.binding import duckdb_source_ctes

AS_OF_SQL = "DATE '2001-08-02'"

# The contract of the staging tables.  Per table its source and the
# column that must not be blank, then one line per column: name, source column,
# kind (text: trimmed; code: trimmed, blank is NULL; int; day; time; or the digits
# and scale of a decimal).
STAGING_COLUMNS = {
    ("stg_customers", "RM00101", "CUSTNMBR"): """
        customer_id CUSTNMBR text
        customer_name CUSTNAME text
        customer_class_id CUSTCLAS code
        corporate_customer_id CPRCSTNM code
        primary_contact_person CNTCPRSN code
        statement_name STMTNAME code
        short_name SHRTNAME code
        address_line1 ADDRESS1 code
        address_line2 ADDRESS2 code
        city CITY code
        state STATE code
        zip_code ZIP code
        country COUNTRY code
        phone_number_1 PHONE1 code
        phone_number_2 PHONE2 code
        fax_number FAX code
        salesperson_id SLPRSNID code
        territory_id SALSTERR code
        payment_terms_id PYMTRMID code
        checkbook_id CHEKBKID code
        credit_limit_type CRLMTTYP int
        credit_limit_amount CRLMTAMT 19,2
        customer_discount_pct CUSTDISC percent
        is_inactive INACTIVE int
        created_at CREATDDT time
        modified_at MODIFDT time""",
    ("stg_customer_classes", "RM00201", "CLASSID"): """
        customer_class_id CLASSID text
        customer_class_description CLASDSCR text
        default_credit_limit_type CRLMTTYP int
        default_credit_limit_amount CRLMTAMT 19,2
        default_checkbook_id CHEKBKID code
        default_payment_terms_id PYMTRMID code
        default_price_level PRCLEVEL code""",
    ("stg_salespeople", "RM00301", "SLPRSNID"): """
        salesperson_id SLPRSNID text
        employee_id EMPLOYID code
        vendor_id VENDORID code
        first_name SLPRSNFN text
        middle_name SPRSNSMN code
        last_name SPRSNSLN text
        full_name SLPRSNFN,SPRSNSLN joined
        job_title SPRNSTTL code
        territory_id SALSTERR code
        commission_pct COMPRCNT percent
        is_inactive INACTIVE int""",
    ("stg_territories", "RM00303", "SALSTERR"): """
        territory_id SALSTERR text
        territory_description SLTERDSC text
        manager_salesperson_id SLPRSNID code
        manager_first_name STMGRFNM code
        manager_last_name STMGRLNM code
        manager_full_name STMGRFNM,STMGRLNM joined
        country COUNTRY code
        is_inactive INACTIVE int""",
    ("stg_sales_headers", "SOP30200", "SOPNUMBE"): """
        sop_type SOPTYPE int
        invoice_number SOPNUMBE text
        document_type_name SOPTYPE sop_label
        doc_id DOCID code
        document_date DOCDATE day
        gl_post_date GLPOSTDT day
        customer_id CUSTNMBR text
        customer_name CUSTNAME text
        salesperson_id SLPRSNID code
        territory_id SALSTERR code
        currency_id CURNCYID code
        payment_terms_id PYMTRMID code
        subtotal_amount SUBTOTAL 19,2
        total_doc_amount DOCAMNT 19,2
        freight_amount FRTAMNT 19,2
        misc_amount MISCAMNT 19,2
        tax_amount TAXAMNT 19,2
        trade_discount_amount TRDISAMT 19,2
        discount_dollars_amount DISCDLND 19,2
        is_voided VOIDSTTS int""",
    ("stg_sales_lines", "SOP30300", "SOPNUMBE"): """
        sop_type SOPTYPE int
        invoice_number SOPNUMBE text
        line_item_sequence LNITMSEQ int
        component_sequence CMPNTSEQ int
        item_number ITEMNMBR text
        item_description ITEMDESC text
        uofm UOFM code
        location_code LOCNCODE code
        document_date DOCDATE day
        customer_id CUSTNMBR text
        quantity QUANTITY 19,4
        unit_price UNITPRCE 19,4
        extended_price XTNDPRCE 19,2
        unit_cost UNITCOST 19,4
        extended_cost EXTDCOST 19,2
        markdown_amount MRKDNAMT 19,2""",
    ("stg_items", "IV00101", "ITEMNMBR"): """
        item_number ITEMNMBR text
        item_description ITEMDESC text
        item_class_code ITMCLSCD code
        item_generic_description ITMGEDSC code
        standard_cost STNDCOST 19,4
        current_cost CURRCOST 19,4
        uom_schedule UOMSCHDL code
        decimal_places_qty DECPLQTY int
        decimal_places_curr DECPLCUR int
        tracking_option ITEMTRKOP int
        is_inactive INACTIVE int""",
    ("stg_fx", "MC00100", "EXGTBLID"): """
        exchange_table_id EXGTBLID text
        currency_id CURNCYID text
        exchange_date EXCHDATE day
        exchange_rate XCHGRATE 19,7
        expiration_date EXPNDATE day""",
    ("stg_item_quantities", "IV00102", "ITEMNMBR"): """
        item_number ITEMNMBR text
        location_code LOCNCODE total_location
        record_type RCRDTYPE int
        qty_on_hand QTYONHND 19,4
        qty_allocated ATYALLOC 19,4
        qty_available QTYONHND,ATYALLOC less
        qty_on_order QTYONORD 19,4
        qty_backorder QTYBKORD 19,4
        safety_stock_qty SFTYSTCKQTY 19,4
        reorder_point_qty ORDRPNTQTY 19,4
        min_order_qty MNMMORDRQTY 19,4
        max_order_qty MXMMORDRQTY 19,4""",
    ("stg_purchase_layers", "IV10200", "ITEMNMBR"): """
        item_number ITEMNMBR text
        location_code TRXLOCTN default_location
        date_received DATERECD day
        receipt_sequence_num RCTSEQNM int
        qty_received QTYRECVD 19,4
        qty_sold QTYSOLD 19,4
        qty_on_hand_layer QTYRECVD,QTYSOLD less
        unit_cost_vef UNITCOST 19,4
        receipt_number RCPTNMBR text
        vendor_id VENDORID code""",
    ("stg_inventory_transactions", "IV30300", "ITEMNMBR"): """
        doc_type DOCTYPE int
        doc_type_desc DOCTYPE movement_label
        doc_number DOCNUMBR text
        doc_date DOCDATE day
        item_number ITEMNMBR text
        from_location_code TRXLOCTN default_location
        to_location_code TRNSTLOC code
        trx_qty TRXQTY 19,4
        unit_cost_vef UNITCOST 19,4
        extended_cost_vef EXTDCOST 19,2""",
    ("stg_open_ar", "RM20101", "CUSTNMBR"): """
        customer_id CUSTNMBR text
        doc_number DOCNUMBR text
        doc_type RMDTYPAL int
        doc_type_desc RMDTYPAL receivable_label
        doc_date DOCDATE day
        due_date DUEDATE day
        orig_amount_vef ORTRXAMT 19,4
        current_balance_vef CURTRXAM 19,4
        currency_id CURNCYID text
        salesperson_id SLPRSNID code
        territory_id SLSTERCD code
        payment_terms_id PYMTRMID text
        gp_aging_bucket AGNGBUKT int
        void_status VOIDSTTS int""",
}
# Rows that a staging table leaves out besides those with a blank key.
STAGING_ROWS = {"stg_fx": f"XCHGRATE > 0 and trim(EXGTBLID) = '{L.FX_TABLE}'", "stg_purchase_layers": "QTYRECVD > QTYSOLD",
                "stg_open_ar": "VOIDSTTS = 0 and CURTRXAM > 0"}


def _label(column: str, labels: dict[int, str], default: str) -> str:
    pairs = ", ".join(f"{k}: '{v}'" for k, v in labels.items())
    return f"coalesce(map {{{pairs}}}[cast({column} as integer)], '{default}')"


def _column(source: str, kind: str) -> str:
    """DuckDB expression of one staging column."""
    one, _, two = source.partition(",")
    code = f"nullif(trim({one}), '')"
    if "," in kind:
        return f"cast({one} as decimal({kind}))"
    return {
        "text": f"trim({one})", "code": code, "int": f"{one}::integer", "day": f"{one}::date", "time": f"{one}::timestamp",
        "percent": f"{one}::decimal(8,4)::double / 100.0", "less": f"({one} - {two})::decimal(19,4)" if two else "",
        "joined": f"trim(concat_ws(' ', trim({one}), coalesce(trim({two}), '')))" if two else "",
        "total_location": f"coalesce({code}, '{L.TOTAL_LOCATION}')",
        "default_location": f"coalesce({code}, '{L.DEFAULT_LOCATION}')",
        "sop_label": _label(one, L.SOP_TYPE_LABELS, L.SOP_TYPE_DEFAULT),
        "movement_label": _label(one, L.IV_DOC_TYPE_LABELS, L.IV_DOC_TYPE_DEFAULT),
        "receivable_label": _label(one, L.AR_TYPE_LABELS, L.AR_TYPE_DEFAULT),
    }[kind]


def _staging_ctes() -> str:
    out = []
    for (name, source, key), lines in STAGING_COLUMNS.items():
        columns = [line.split() for line in lines.split("\n") if line.strip()]
        listed = ", ".join(f"{_column(src, kind)} as {col}" for col, src, kind in columns)
        rows = STAGING_ROWS.get(name, "true")
        out.append(f"{name} as (select {listed} from {source} where coalesce(trim({key}), '') <> '' and {rows})")
    return ",\n".join(out)


STAGING_CTES = _staging_ctes()


def with_prelude(*ctes: str, final: str) -> str:
    """Assemble ``WITH binding, staging, <ctes> <final>``."""
    parts = [duckdb_source_ctes(), STAGING_CTES.strip()] + [c.strip().rstrip(",") for c in ctes if c.strip()]
    return "with " + ",\n".join(parts) + "\n" + final.strip()


def dbl(*cols: str) -> str:
    """``* REPLACE`` clause casting the listed columns to double."""
    return "* replace (" + ", ".join(f"cast({c} as double) as {c}" for c in cols) + ")"
