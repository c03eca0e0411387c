"""Staging layer T01–T12: 1:1 rename, trim, typed cast and key filter.

Each function takes the raw ERP source frame and returns the cleaned frame.
All work is projection + filter, so Catalyst fuses each one into the scan stage
(no shuffle) and pushes the key predicates down to the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.clean import code_label, concat_skip_nulls, dec, integer, not_blank, opt_txt, opt_txt_or, txt


def stg_customers(rm00101: DataFrame) -> DataFrame:
    """T01 customers (RM00101)."""
    s = rm00101
    return s.where(not_blank("CUSTNMBR")).select(
        txt("CUSTNMBR").alias("customer_id"),
        txt("CUSTNAME").alias("customer_name"),
        opt_txt("CUSTCLAS").alias("customer_class_id"),
        opt_txt("CPRCSTNM").alias("corporate_customer_id"),
        opt_txt("CNTCPRSN").alias("primary_contact_person"),
        opt_txt("STMTNAME").alias("statement_name"),
        opt_txt("SHRTNAME").alias("short_name"),
        opt_txt("ADDRESS1").alias("address_line1"),
        opt_txt("ADDRESS2").alias("address_line2"),
        opt_txt("CITY").alias("city"),
        opt_txt("STATE").alias("state"),
        opt_txt("ZIP").alias("zip_code"),
        opt_txt("COUNTRY").alias("country"),
        opt_txt("PHONE1").alias("phone_number_1"),
        opt_txt("PHONE2").alias("phone_number_2"),
        opt_txt("FAX").alias("fax_number"),
        opt_txt("SLPRSNID").alias("salesperson_id"),
        opt_txt("SALSTERR").alias("territory_id"),
        opt_txt("PYMTRMID").alias("payment_terms_id"),
        opt_txt("CHEKBKID").alias("checkbook_id"),
        integer("CRLMTTYP").alias("credit_limit_type"),
        dec("CRLMTAMT", 19, 2).alias("credit_limit_amount"),
        (dec("CUSTDISC", 8, 4).cast("double") / F.lit(100.0)).alias("customer_discount_pct"),
        integer("INACTIVE").alias("is_inactive"),
        F.col("CREATDDT").try_cast("timestamp").alias("created_at"),
        F.col("MODIFDT").try_cast("timestamp").alias("modified_at"),
    )


def stg_customer_classes(rm00201: DataFrame) -> DataFrame:
    """T02 customer classes (RM00201)."""
    return rm00201.where(not_blank("CLASSID")).select(
        txt("CLASSID").alias("customer_class_id"),
        txt("CLASDSCR").alias("customer_class_description"),
        integer("CRLMTTYP").alias("default_credit_limit_type"),
        dec("CRLMTAMT", 19, 2).alias("default_credit_limit_amount"),
        opt_txt("CHEKBKID").alias("default_checkbook_id"),
        opt_txt("PYMTRMID").alias("default_payment_terms_id"),
        opt_txt("PRCLEVEL").alias("default_price_level"),
    )


def stg_salespeople(rm00301: DataFrame) -> DataFrame:
    """T03 salespeople (RM00301); ``full_name`` skips a NULL last name."""
    return rm00301.where(not_blank("SLPRSNID")).select(
        txt("SLPRSNID").alias("salesperson_id"),
        opt_txt("EMPLOYID").alias("employee_id"),
        opt_txt("VENDORID").alias("vendor_id"),
        txt("SLPRSNFN").alias("first_name"),
        opt_txt("SPRSNSMN").alias("middle_name"),
        txt("SPRSNSLN").alias("last_name"),
        F.trim(concat_skip_nulls(txt("SLPRSNFN"), F.lit(" "), F.coalesce(txt("SPRSNSLN"), F.lit("")))).alias("full_name"),
        opt_txt("SPRNSTTL").alias("job_title"),
        opt_txt("SALSTERR").alias("territory_id"),
        (dec("COMPRCNT", 23, 4).cast("double") / F.lit(100.0)).alias("commission_pct"),
        integer("INACTIVE").alias("is_inactive"),
    )


def stg_territories(rm00303: DataFrame) -> DataFrame:
    """T04 sales territories (RM00303)."""
    return rm00303.where(not_blank("SALSTERR")).select(
        txt("SALSTERR").alias("territory_id"),
        txt("SLTERDSC").alias("territory_description"),
        opt_txt("SLPRSNID").alias("manager_salesperson_id"),
        opt_txt("STMGRFNM").alias("manager_first_name"),
        opt_txt("STMGRLNM").alias("manager_last_name"),
        F.trim(concat_skip_nulls(F.coalesce(txt("STMGRFNM"), F.lit("")), F.lit(" "),
                                 F.coalesce(txt("STMGRLNM"), F.lit("")))).alias("manager_full_name"),
        opt_txt("COUNTRY").alias("country"),
        integer("INACTIVE").alias("is_inactive"),
    )


def stg_sales_headers(sop30200: DataFrame) -> DataFrame:
    """T05 historical sales document headers (SOP30200)."""
    return sop30200.where(not_blank("SOPNUMBE")).select(
        integer("SOPTYPE").alias("sop_type"),
        txt("SOPNUMBE").alias("invoice_number"),
        code_label(integer("SOPTYPE"), L.SOP_TYPE_LABELS, L.SOP_TYPE_DEFAULT).alias("document_type_name"),
        opt_txt("DOCID").alias("doc_id"),
        F.col("DOCDATE").try_cast("date").alias("document_date"),
        F.col("GLPOSTDT").try_cast("date").alias("gl_post_date"),
        txt("CUSTNMBR").alias("customer_id"),
        txt("CUSTNAME").alias("customer_name"),
        opt_txt("SLPRSNID").alias("salesperson_id"),
        opt_txt("SALSTERR").alias("territory_id"),
        opt_txt("CURNCYID").alias("currency_id"),
        opt_txt("PYMTRMID").alias("payment_terms_id"),
        dec("SUBTOTAL", 19, 2).alias("subtotal_amount"),
        dec("DOCAMNT", 19, 2).alias("total_doc_amount"),
        dec("FRTAMNT", 19, 2).alias("freight_amount"),
        dec("MISCAMNT", 19, 2).alias("misc_amount"),
        dec("TAXAMNT", 19, 2).alias("tax_amount"),
        dec("TRDISAMT", 19, 2).alias("trade_discount_amount"),
        dec("DISCDLND", 19, 2).alias("discount_dollars_amount"),
        integer("VOIDSTTS").alias("is_voided"),
    )


def stg_sales_lines(sop30300: DataFrame) -> DataFrame:
    """T06 historical sales document lines (SOP30300)."""
    return sop30300.where(not_blank("SOPNUMBE")).select(
        integer("SOPTYPE").alias("sop_type"),
        txt("SOPNUMBE").alias("invoice_number"),
        integer("LNITMSEQ").alias("line_item_sequence"),
        integer("CMPNTSEQ").alias("component_sequence"),
        txt("ITEMNMBR").alias("item_number"),
        txt("ITEMDESC").alias("item_description"),
        opt_txt("UOFM").alias("uofm"),
        opt_txt("LOCNCODE").alias("location_code"),
        F.col("DOCDATE").try_cast("date").alias("document_date"),
        txt("CUSTNMBR").alias("customer_id"),
        dec("QUANTITY", 19, 4).alias("quantity"),
        dec("UNITPRCE", 19, 4).alias("unit_price"),
        dec("XTNDPRCE", 19, 2).alias("extended_price"),
        dec("UNITCOST", 19, 4).alias("unit_cost"),
        dec("EXTDCOST", 19, 2).alias("extended_cost"),
        dec("MRKDNAMT", 19, 2).alias("markdown_amount"),
    )


def stg_items(iv00101: DataFrame) -> DataFrame:
    """T07 item master (IV00101)."""
    return iv00101.where(not_blank("ITEMNMBR")).select(
        txt("ITEMNMBR").alias("item_number"),
        txt("ITEMDESC").alias("item_description"),
        opt_txt("ITMCLSCD").alias("item_class_code"),
        opt_txt("ITMGEDSC").alias("item_generic_description"),
        dec("STNDCOST", 19, 4).alias("standard_cost"),
        dec("CURRCOST", 19, 4).alias("current_cost"),
        opt_txt("UOMSCHDL").alias("uom_schedule"),
        integer("DECPLQTY").alias("decimal_places_qty"),
        integer("DECPLCUR").alias("decimal_places_curr"),
        integer("ITEMTRKOP").alias("tracking_option"),
        integer("INACTIVE").alias("is_inactive"),
    )


def stg_fx(mc00100: DataFrame, table_id: str = L.FX_TABLE) -> DataFrame:
    """T08 exchange rates of one rate table with a positive rate (MC00100)."""
    return mc00100.where((F.trim("EXGTBLID") == F.lit(table_id)) & (F.col("XCHGRATE") > 0)).select(
        txt("EXGTBLID").alias("exchange_table_id"),
        txt("CURNCYID").alias("currency_id"),
        F.col("EXCHDATE").try_cast("date").alias("exchange_date"),
        dec("XCHGRATE", 19, 7).alias("exchange_rate"),
        F.col("EXPNDATE").try_cast("date").alias("expiration_date"),
    )


def stg_item_quantities(iv00102: DataFrame) -> DataFrame:
    """T09 item quantities per site; blank site = item total row."""
    return iv00102.where(not_blank("ITEMNMBR")).select(
        txt("ITEMNMBR").alias("item_number"),
        opt_txt_or("LOCNCODE", L.TOTAL_LOCATION).alias("location_code"),
        integer("RCRDTYPE").alias("record_type"),
        dec("QTYONHND", 19, 4).alias("qty_on_hand"),
        dec("ATYALLOC", 19, 4).alias("qty_allocated"),
        (F.col("QTYONHND") - F.col("ATYALLOC")).try_cast("decimal(19,4)").alias("qty_available"),
        dec("QTYONORD", 19, 4).alias("qty_on_order"),
        dec("QTYBKORD", 19, 4).alias("qty_backorder"),
        dec("SFTYSTCKQTY", 19, 4).alias("safety_stock_qty"),
        dec("ORDRPNTQTY", 19, 4).alias("reorder_point_qty"),
        dec("MNMMORDRQTY", 19, 4).alias("min_order_qty"),
        dec("MXMMORDRQTY", 19, 4).alias("max_order_qty"),
    )


def stg_purchase_layers(iv10200: DataFrame) -> DataFrame:
    """T10 purchase receipt layers with stock left in the layer."""
    remaining = F.col("QTYRECVD") - F.col("QTYSOLD")
    return iv10200.where(remaining > 0).select(
        txt("ITEMNMBR").alias("item_number"),
        opt_txt_or("TRXLOCTN", L.DEFAULT_LOCATION).alias("location_code"),
        F.col("DATERECD").try_cast("date").alias("date_received"),
        integer("RCTSEQNM").alias("receipt_sequence_num"),
        dec("QTYRECVD", 19, 4).alias("qty_received"),
        dec("QTYSOLD", 19, 4).alias("qty_sold"),
        remaining.try_cast("decimal(19,4)").alias("qty_on_hand_layer"),
        dec("UNITCOST", 19, 4).alias("unit_cost_vef"),
        txt("RCPTNMBR").alias("receipt_number"),
        opt_txt("VENDORID").alias("vendor_id"),
    )


def stg_inventory_transactions(iv30300: DataFrame) -> DataFrame:
    """T11 posted inventory transactions (IV30300)."""
    return iv30300.where(not_blank("ITEMNMBR")).select(
        integer("DOCTYPE").alias("doc_type"),
        code_label(integer("DOCTYPE"), L.IV_DOC_TYPE_LABELS, L.IV_DOC_TYPE_DEFAULT).alias("doc_type_desc"),
        txt("DOCNUMBR").alias("doc_number"),
        F.col("DOCDATE").try_cast("date").alias("doc_date"),
        txt("ITEMNMBR").alias("item_number"),
        opt_txt_or("TRXLOCTN", L.DEFAULT_LOCATION).alias("from_location_code"),
        opt_txt("TRNSTLOC").alias("to_location_code"),
        dec("TRXQTY", 19, 4).alias("trx_qty"),
        dec("UNITCOST", 19, 4).alias("unit_cost_vef"),
        dec("EXTDCOST", 19, 2).alias("extended_cost_vef"),
    )


def stg_open_ar(rm20101: DataFrame) -> DataFrame:
    """T12 open receivable documents with a balance, not voided."""
    return rm20101.where((F.col("CURTRXAM") > 0) & (F.col("VOIDSTTS") == 0)).select(
        txt("CUSTNMBR").alias("customer_id"),
        txt("DOCNUMBR").alias("doc_number"),
        integer("RMDTYPAL").alias("doc_type"),
        code_label(integer("RMDTYPAL"), L.AR_TYPE_LABELS, L.AR_TYPE_DEFAULT).alias("doc_type_desc"),
        F.col("DOCDATE").try_cast("date").alias("doc_date"),
        F.col("DUEDATE").try_cast("date").alias("due_date"),
        dec("ORTRXAMT", 19, 4).alias("orig_amount_vef"),
        dec("CURTRXAM", 19, 4).alias("current_balance_vef"),
        txt("CURNCYID").alias("currency_id"),
        opt_txt("SLPRSNID").alias("salesperson_id"),
        opt_txt("SLSTERCD").alias("territory_id"),
        txt("PYMTRMID").alias("payment_terms_id"),
        integer("AGNGBUKT").alias("gp_aging_bucket"),
        integer("VOIDSTTS").alias("void_status"),
    )
