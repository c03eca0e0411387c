"""Source registry (S02): the ERP tables the marts read, with their database,
description and the typed schema of the columns used (FIXTURES.md §1)."""

from __future__ import annotations

from pyspark.sql.types import (DateType, DecimalType, IntegerType, StringType, StructField, StructType,
                               TimestampType)

S = StringType()
I = IntegerType()  # noqa: E741
DT = DateType()
TS = TimestampType()


def dec(p: int, s: int) -> DecimalType:
    return DecimalType(p, s)


def _schema(**cols) -> StructType:
    return StructType([StructField(k, v, True) for k, v in cols.items()])


# Source tables (database, description, schema).
SOURCES: dict[str, tuple[str, str, StructType]] = {
    "RM00101": ("ERP", "customer master", _schema(
        CUSTNMBR=S, CUSTNAME=S, CUSTCLAS=S, CPRCSTNM=S, CNTCPRSN=S, STMTNAME=S, SHRTNAME=S, ADDRESS1=S, ADDRESS2=S,
        CITY=S, STATE=S, ZIP=S, COUNTRY=S, PHONE1=S, PHONE2=S, FAX=S, SLPRSNID=S, SALSTERR=S, PYMTRMID=S,
        CHEKBKID=S, CRLMTTYP=I, CRLMTAMT=dec(19, 2), CUSTDISC=dec(8, 4), INACTIVE=I, CREATDDT=TS, MODIFDT=TS)),
    "RM00201": ("ERP", "customer classes", _schema(
        CLASSID=S, CLASDSCR=S, CRLMTTYP=I, CRLMTAMT=dec(19, 2), CHEKBKID=S, PYMTRMID=S, PRCLEVEL=S)),
    "RM00301": ("ERP", "salespeople", _schema(
        SLPRSNID=S, EMPLOYID=S, VENDORID=S, SLPRSNFN=S, SPRSNSMN=S, SPRSNSLN=S, SPRNSTTL=S, SALSTERR=S,
        COMPRCNT=dec(23, 4), INACTIVE=I)),
    "RM00303": ("ERP", "sales territories", _schema(
        SALSTERR=S, SLTERDSC=S, SLPRSNID=S, STMGRFNM=S, STMGRLNM=S, COUNTRY=S, INACTIVE=I)),
    "SOP30200": ("ERP", "historical sales document headers", _schema(
        SOPTYPE=I, SOPNUMBE=S, DOCID=S, DOCDATE=DT, GLPOSTDT=DT, CUSTNMBR=S, CUSTNAME=S, SLPRSNID=S, SALSTERR=S,
        CURNCYID=S, PYMTRMID=S, SUBTOTAL=dec(19, 2), DOCAMNT=dec(19, 2), FRTAMNT=dec(19, 2), MISCAMNT=dec(19, 2),
        TAXAMNT=dec(19, 2), TRDISAMT=dec(19, 2), DISCDLND=dec(19, 2), VOIDSTTS=I, XCHGRATE=dec(19, 7))),
    "SOP30300": ("ERP", "historical sales document lines", _schema(
        SOPTYPE=I, SOPNUMBE=S, LNITMSEQ=I, CMPNTSEQ=I, ITEMNMBR=S, ITEMDESC=S, UOFM=S, LOCNCODE=S, DOCDATE=DT,
        CUSTNMBR=S, QUANTITY=dec(19, 4), UNITPRCE=dec(19, 4), XTNDPRCE=dec(19, 2), UNITCOST=dec(19, 4),
        EXTDCOST=dec(19, 2), MRKDNAMT=dec(19, 2), OXTNDPRC=dec(19, 2))),
    "IV00101": ("ERP", "item master", _schema(
        ITEMNMBR=S, ITEMDESC=S, ITMCLSCD=S, ITMGEDSC=S, STNDCOST=dec(19, 4), CURRCOST=dec(19, 4), UOMSCHDL=S,
        DECPLQTY=I, DECPLCUR=I, ITEMTRKOP=I, INACTIVE=I)),
    "IV00102": ("ERP", "item quantities per site", _schema(
        ITEMNMBR=S, LOCNCODE=S, RCRDTYPE=I, QTYONHND=dec(19, 4), ATYALLOC=dec(19, 4), QTYONORD=dec(19, 4),
        QTYBKORD=dec(19, 4), SFTYSTCKQTY=dec(19, 4), ORDRPNTQTY=dec(19, 4), MNMMORDRQTY=dec(19, 4),
        MXMMORDRQTY=dec(19, 4))),
    "IV10200": ("ERP", "purchase receipt layers", _schema(
        ITEMNMBR=S, TRXLOCTN=S, DATERECD=DT, RCTSEQNM=I, QTYRECVD=dec(19, 4), QTYSOLD=dec(19, 4),
        UNITCOST=dec(19, 4), RCPTNMBR=S, VENDORID=S)),
    "IV30300": ("ERP", "inventory transaction history", _schema(
        DOCTYPE=I, DOCNUMBR=S, DOCDATE=DT, ITEMNMBR=S, TRXLOCTN=S, TRNSTLOC=S, TRXQTY=dec(19, 4),
        UNITCOST=dec(19, 4), EXTDCOST=dec(19, 2))),
    "IV40700": ("ERP", "warehouse sites", _schema(LOCNCODE=S, LOCNDSCR=S)),
    "RM20101": ("ERP", "open receivables", _schema(
        CUSTNMBR=S, DOCNUMBR=S, RMDTYPAL=I, DOCDATE=DT, DUEDATE=DT, ORTRXAMT=dec(19, 4), CURTRXAM=dec(19, 4),
        CURNCYID=S, SLPRSNID=S, SLSTERCD=S, PYMTRMID=S, AGNGBUKT=I, VOIDSTTS=I)),
    "MC00100": ("SYSTEM", "exchange rates", _schema(
        EXGTBLID=S, CURNCYID=S, EXCHDATE=DT, XCHGRATE=dec(19, 7), EXPNDATE=DT)),
}


def schema_of(source: str) -> StructType:
    return SOURCES[source][2]
