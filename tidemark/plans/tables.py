"""Source columns the transformations use, by table."""

from __future__ import annotations


def _numbered(prefix: str, count: int) -> str:
    return " ".join(f"{prefix}_{i}" for i in range(count))


# Names of the source tables and columns.
SOURCE_COLUMNS: dict[str, list[str]] = {
    table: columns.split()
    for table, columns in {
        "COMPANY": "CPY_0 CPYNAM_0 ROWID",
        "SALESREP": "REPNUM_0 REPNAM_0 ROWID",
        "BPCUSTOMER": f"ROWID BPCNUM_0 BPCNAM_0 BCGCOD_0 {_numbered('TSCCOD', 5)}",
        "BPSUPPLIER": f"ROWID BPSNUM_0 BPSNAM_0 BSGCOD_0 {_numbered('TSSCOD', 3)}",
        "BPARTNER": "BPRNUM_0 CRY_0",
        "ATEXTRA": "CODFIC_0 ZONE_0 LANGUE_0 IDENT1_0 IDENT2_0 TEXTE_0",
        "ITMMASTER": f"ITMREF_0 ITMDES1_0 ITMDES2_0 ITMDES3_0 TCLCOD_0 {_numbered('TSICOD', 5)} ROWID",
        "YREPRE": "YBPCNUM_0 YCPY_0 YREP_0",
        "SQUOTE": "SQHNUM_0 CPY_0 BPCORD_0 QUODAT_0 CHGRAT_0",
        "SQUOTED": "SQHNUM_0 ITMREF_0 QTY_0 NETPRI_0 NETPRIATI_0 ROWID",
        "SORDER": "ROWID SOHNUM_0 CPY_0 BPCORD_0 ORDDAT_0 CHGRAT_0",
        "SORDERQ": "SOHNUM_0 ITMREF_0 QTY_0",
        "SORDERP": "SOHNUM_0 NETPRI_0 NETPRIATI_0 CPRPRI_0",
        "SDELIVERY": "ROWID SDHNUM_0 CPY_0 BPCORD_0 SHIDAT_0 CHGRAT_0",
        "SDELIVERYD": "SDHNUM_0 ITMREF_0 QTY_0 RTNQTY_0 NETPRI_0 CPRPRI_0",
        "SINVOICE": "NUM_0 CPY_0 BPR_0 ACCDAT_0 SNS_0 RATMLT_0",
        "SINVOICED": "ROWID NUM_0 SIDLIN_0 ITMREF_0 QTY_0 NETPRI_0 NETPRIATI_0 CPRPRI_0",
        "PORDER": "ROWID POHNUM_0 CPY_0 BPSNUM_0 ORDDAT_0 CHGCOE_0",
        "PORDERQ": "POHNUM_0 ITMREF_0 QTYSTU_0",
        "PORDERP": "POHNUM_0 NETPRI_0",
        "PRECEIPT": "ROWID PTHNUM_0 CPY_0 BPSNUM_0 RCPDAT_0 CHGCOE_0",
        "PRECEIPTD": "PTHNUM_0 ITMREF_0 QTYSTU_0 RTNQTYSTU_0 NETPRI_0",
        "FACILITY": "FCY_0 LEGCPY_0",
        "MFGITMTRK": "MFGTRKNUM_0 ITMREF_0 MFGFCY_0 CPLQTY_0 IPTDAT_0",
        "MFGOPETRK": "MFGTRKNUM_0 MFGFCY_0 CPLWST_0 CPLLAB_0 CPLQTY_0 REJCPLQTY_0 CPLSETTIM_0 CPLOPETIM_0 TIMTYP_0 "
        "TIMUOMCOD_0 MSGNUM_0 IPTDAT_0",
        "WORKSTATIO": "WST_0 TWD_0 WSTDES_0 WCRFCY_0",
        "TABWEEDIA": f"TWD_0 {_numbered('DAYCAP', 7)}",
    }.items()
}
