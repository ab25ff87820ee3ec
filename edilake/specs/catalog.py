"""The transaction specs that ship with the package.

They are our own small specs of the loops and segments that bulk pipelines meet most; the complete industry
specs are licensed documents and can be loaded from XML with ``parse_spec_xml``.
"""

from __future__ import annotations

from .model import Loop, Seg, Spec, comp, ele, loop, seg

# Supported file types and the version text each one needs in GS08.
VERSIONS = {
    "ANSI834_5010_X220": "005010X220A1",
    "ANSI835_5010_X221": "005010X221A1",
    "ANSI835_4010_X091": "004010X091A1",
    "ANSI837_4010_X096": "004010X096A1",
    "ANSI837_4010_X097": "004010X097A1",
    "ANSI837_4010_X098": "004010X098A1",
    "ANSI837_5010_X222": "005010X222A1",
    "ANSI837_5010_X223": "005010X223A2",
    "ANSI837_5010_X231": "005010X231A1",
    "ANSI277_5010_X214": "005010X214",
    "ANSI270_4010_X092": "004010X092A1",
    "ANSI271_4010_X092": "004010X092A1",
    "ANSI277_5010_X212": "005010X212",
}

# Interchange version (ISA12), functional id (GS01), version (GS08), purpose (BHT02, "-" for any), short name
# of the map, and the file type that reads it ("-" if none does).
ROUTES = """
00400 PS 004010 - 830 -
00401 HN 004010X070 - 277U -
00401 HR 004010X093A1 - 276 -
00401 HN 004010X093A1 - 277 -
00401 HS 004010X092A1 - 270 ANSI270_4010_X092
00401 HB 004010X092A1 - 271 ANSI271_4010_X092
00401 HI 004010X094A1 11 278a -
00401 HI 004010X094A1 13 278b -
00401 RA 004010X061A1 - 820 -
00401 BE 004010X095A1 - 834 -
00401 HP 004010X091A1 - 835 ANSI835_4010_X091
00401 HC 004010X096A1 - 837I ANSI837_4010_X096
00401 HC 004010X097A1 - 837D ANSI837_4010_X097
00401 HC 004010X098A1 - 837P ANSI837_4010_X098
00401 SP 004010XXXC - 841 -
00401 FA 004010 - 997 -
00401 FA 004010X070 - 997 -
00401 FA 004010X093A1 - 997 -
00401 FA 004010X092A1 - 997 -
00401 FA 004010X094A1 - 997 -
00401 FA 004010X061A1 - 997 -
00401 FA 004010X095A1 - 997 -
00401 FA 004010X091A1 - 997 -
00401 FA 004010X096A1 - 997 -
00401 FA 004010X097A1 - 997 -
00401 FA 004010X098A1 - 997 -
00501 RA 005010X218 - 820 -
00501 BE 005010X220A1 - 834 ANSI834_5010_X220
00501 HP 005010X221A1 - 835W1 ANSI835_5010_X221
00501 HC 005010X223A2 - 837Q3 ANSI837_5010_X223
00501 FA 005010X231A1 - 999 ANSI837_5010_X231
00501 FA 005010X231 - 999 ANSI837_5010_X231
00501 HC 005010X222A1 - 837P ANSI837_5010_X222
00501 HN 005010X214 - 277CA ANSI277_5010_X214
00501 HN 005010X212 - 277 ANSI277_5010_X212
"""

ROUTE_DDL = "icvn string, fic string, version string, purpose string, route string, spec_id string"


def route_rows() -> list[tuple[str, ...]]:
    return [tuple(None if v == "-" else v for v in line.split()) for line in ROUTES.strip().splitlines()]


def envelope(*body: Seg | Loop) -> Loop:
    """ISA > GS > ST around the given content; the same for every transaction type."""
    st = loop("ST_LOOP", "Transaction Set", "R", "020", ">1",
              seg("ST", "Transaction Set Header", "R", "005", "1",
                  ele(1, "Transaction Set Identifier Code", "R"), ele(2, "Transaction Set Control Number", "R")),
              *body,
              seg("SE", "Transaction Set Trailer", "R", "990", "1",
                  ele(1, "Number of Included Segments", "R"), ele(2, "Transaction Set Control Number", "R")))
    gs = loop("GS_LOOP", "Functional Group", "R", "020", ">1",
              seg("GS", "Functional Group Header", "R", "010", "1",
                  ele(1, "Functional Identifier Code", "R"), ele(2, "Application Sender's Code", "R"),
                  ele(3, "Application Receiver's Code", "R"), ele(4, "Date", "R"), ele(5, "Time", "R"),
                  ele(6, "Group Control Number", "R"), ele(7, "Responsible Agency Code", "R", "X"),
                  ele(8, "Version Code", "R")),
              st,
              seg("GE", "Functional Group Trailer", "R", "030", "1",
                  ele(1, "Number of Transaction Sets", "R"), ele(2, "Group Control Number", "R")))
    return loop("ISA_LOOP", "Interchange", "R", "001", ">1",
                seg("ISA", "Interchange Control Header", "R", "010", "1",
                    ele(1, "Authorization Information Qualifier", "R", "00 03"), ele(2, "Authorization Information", "R"),
                    ele(3, "Security Information Qualifier", "R", "00 01"), ele(4, "Security Information", "R"),
                    ele(5, "Sender ID Qualifier", "R", "01 14 20 27 28 29 30 33 ZZ"), ele(6, "Sender ID", "R"),
                    ele(7, "Receiver ID Qualifier", "R", "01 14 20 27 28 29 30 33 ZZ"), ele(8, "Receiver ID", "R"),
                    ele(9, "Interchange Date", "R"), ele(10, "Interchange Time", "R"),
                    ele(11, "Repetition Separator", "R"), ele(12, "Interchange Version", "R", "00401 00501"),
                    ele(13, "Interchange Control Number", "R"), ele(14, "Acknowledgment Requested", "R", "0 1"),
                    ele(15, "Usage Indicator", "R", "P T"), ele(16, "Component Separator", "R")),
                gs,
                seg("IEA", "Interchange Control Trailer", "R", "030", "1",
                    ele(1, "Number of Groups", "R"), ele(2, "Interchange Control Number", "R")))


def bht() -> Seg:
    return seg("BHT", "Beginning of Hierarchical Transaction", "R", "010", "1",
               ele(1, "Structure Code", "R"), ele(2, "Purpose Code", "R"), ele(3, "Reference", "S"),
               ele(4, "Date", "R"), ele(5, "Time", "R"))


def level(code: str, name: str, pos: str = "010") -> Seg:
    return seg("HL", name, "R", pos, "1", ele(1, "Level ID", "R"), ele(2, "Parent Level ID"),
               ele(3, "Level Code", "R", code), ele(4, "Has Children"))


def name_seg(code: str, name: str, pos: str, usage: str = "R") -> Seg:
    return seg("NM1", name, usage, pos, "1", ele(1, "Entity Identifier", "R", code), ele(2, "Entity Type", "R"),
               ele(3, "Last or Organization Name"), ele(4, "First Name"), ele(5, "Middle Name"), ele(7, "Suffix"),
               ele(8, "ID Qualifier"), ele(9, "ID"))


def street(pos: str, usage: str = "S") -> Seg:
    return seg("N3", "Street Address", usage, pos, "1", ele(1, "Address Line", "R"), ele(2, "Address Line 2"))


def city(pos: str, usage: str = "S") -> Seg:
    return seg("N4", "City, State, ZIP", usage, pos, "1", ele(1, "City", "R"), ele(2, "State"), ele(3, "ZIP"))


def ref(pos: str, max_use: str = ">1", codes: str = "", usage: str = "S") -> Seg:
    return seg("REF", "Reference", usage, pos, max_use, ele(1, "Reference Qualifier", "R", codes), ele(2, "Reference", "R"))


def party(xid: str, code: str, name: str, pos: str, repeat: str, *rest: Seg, usage: str = "S") -> Loop:
    return loop(xid, name, usage, pos, repeat, name_seg(code, name, "010"), *rest)


def demographics(pos: str) -> Seg:
    return seg("DMG", "Demographics", "S", pos, "1", ele(1, "Format", "R", "D8"), ele(2, "Birth Date", "R"), ele(3, "Gender"))


def date_seg(name: str, usage: str, pos: str, max_use: str, codes: str = "") -> Seg:
    return seg("DTP", name, usage, pos, max_use, ele(1, "Date Qualifier", "R", codes),
               ele(2, "Date Format", "R", "D8 RD8 DT"), ele(3, "Date", "R"))


def claim_loop() -> Loop:
    other_payer = loop(
        "2320", "Other Subscriber", "S", "290", "10",
        seg("SBR", "Other Subscriber Information", "R", "010", "1", ele(1, "Payer Order", "R", "P S T"),
            ele(2, "Relationship"), ele(3, "Group"), ele(9, "Filing Code")),
        seg("OI", "Other Insurance", "R", "020", "1", ele(3, "Assignment", "R")),
        party("2330A", "IL", "Other Subscriber Name", "030", "1", ref("040")),
        party("2330B", "PR", "Other Payer", "040", "1", ref("040")),
        party("2330C", "DN", "Other Payer Referring", "050", "2", ref("040")),
        party("2330D", "82", "Other Payer Rendering", "060", "1", ref("040")),
        party("2330E", "77", "Other Payer Facility", "070", "1", ref("040")),
        party("2330F", "DQ", "Other Payer Supervising", "080", "1", ref("040")),
        party("2330G", "85", "Other Payer Billing", "090", "1", ref("040")),
    )
    line = loop(
        "2400", "Service Line", "R", "300", ">1",
        seg("LX", "Line Number", "R", "010", "1", ele(1, "Assigned Number", "R")),
        seg("SV1", "Professional Service", "R", "020", "1",
            comp(1, "Procedure", "R", "Product Qualifier, Procedure Code, Modifier 1, Modifier 2, Modifier 3, Modifier 4"),
            ele(2, "Line Charge", "R"), ele(3, "Unit", "R", "MJ UN"), ele(4, "Quantity", "R"), ele(5, "Place"),
            comp(7, "Diagnosis Pointer", "S", "Pointer 1, Pointer 2, Pointer 3, Pointer 4"), ele(9, "Emergency")),
        date_seg("Line Date", "R", "030", "15"),
        loop("2410", "Drug", "S", "040", "1",
             seg("LIN", "Drug Identification", "R", "010", "1", ele(2, "Drug Qualifier", "R", "N4"), ele(3, "Drug Code", "R")),
             seg("CTP", "Drug Quantity", "S", "020", "1", ele(4, "Quantity", "R"), comp(5, "Unit", "R", "Unit"))),
        party("2420A", "82", "Line Rendering Provider", "050", "1",
              seg("PRV", "Provider Specialty", "S", "020", "1", ele(1, "Provider Code", "R")), ref("030")),
        party("2420B", "QB", "Purchased Service", "060", "1", ref("030")),
        party("2420C", "77", "Line Facility", "070", "1", street("020"), city("030"), ref("040")),
        party("2420D", "DQ", "Line Supervising", "080", "1", ref("030")),
        party("2420E", "DK", "Line Ordering", "090", "1", street("020"), city("030"), ref("040")),
        party("2420F", "DN", "Line Referring", "100", "2", ref("030")),
        party("2420G", "PW", "Line Pick-up", "110", "1", street("020"), city("030")),
        party("2420H", "45", "Line Drop-off", "120", "1", street("020"), city("030")),
        loop("2430", "Line Adjudication", "S", "130", "15",
             seg("SVD", "Line Adjudication", "R", "010", "1", ele(1, "Payer ID", "R"), ele(2, "Paid Amount", "R"),
                 comp(3, "Procedure", "R", "Product Qualifier, Procedure Code")),
             date_seg("Paid Date", "R", "020", "1", "573")),
        loop("2440", "Form", "S", "140", ">1",
             seg("LQ", "Form Identification", "R", "010", "1", ele(1, "Form Qualifier", "R", "AS UT"), ele(2, "Form ID", "R")),
             seg("FRM", "Supporting Documentation", "R", "020", "99", ele(1, "Question", "R"))),
    )
    return loop(
        "2300", "Claim", "R", "130", "100",
        seg("CLM", "Claim Information", "R", "010", "1", ele(1, "Claim Number", "R"), ele(2, "Claim Amount", "R"),
            comp(5, "Place of Service", "R", "Place, Qualifier, Frequency"), ele(6, "Signature"), ele(7, "Assignment"),
            ele(8, "Benefits"), ele(9, "Release"), ele(10, "Patient Signature")),
        date_seg("Claim Date", "S", "020", "20"),
        ref("030"),
        seg("HI", "Diagnosis", "R", "040", "1", comp(1, "Diagnosis 1", "R", "Qualifier, Code"),
            comp(2, "Diagnosis 2", "S", "Qualifier, Code")),
        party("2310A", "DN", "Referring Provider", "210", "2", ref("030")),
        party("2310B", "82", "Rendering Provider", "220", "1",
              seg("PRV", "Provider Specialty", "S", "020", "1", ele(1, "Provider Code", "R")), ref("030")),
        party("2310C", "77", "Service Facility", "230", "1", street("020"), city("030"), ref("040")),
        party("2310D", "DQ", "Supervising Provider", "240", "1", ref("030")),
        party("2310E", "PW", "Pick-up", "250", "1", street("020"), city("030")),
        party("2310F", "45", "Drop-off", "260", "1", street("020"), city("030")),
        other_payer,
        line,
    )


def professional_claim() -> Spec:
    contact = seg("PER", "Contact", "R", "050", "2", ele(1, "Contact Function", "R", "IC"), ele(2, "Contact Name"),
                  ele(3, "Number Qualifier", "R"), ele(4, "Number", "R"))
    patient = loop(
        "2000C", "Patient Level", "S", "140", ">1", level("23", "Patient Level"),
        seg("PAT", "Patient Information", "R", "020", "1", ele(1, "Relationship", "R")),
        party("2010CA", "QC", "Patient", "030", "1", street("020"), city("030"), demographics("040"), usage="R"),
        claim_loop())
    subscriber = loop(
        "2000B", "Subscriber Level", "R", "060", ">1", level("22", "Subscriber Level"),
        seg("SBR", "Subscriber Information", "R", "020", "1", ele(1, "Payer Order", "R", "P S T"), ele(2, "Relationship"),
            ele(3, "Group"), ele(9, "Filing Code")),
        party("2010BA", "IL", "Subscriber", "030", "1", street("020"), city("030"), demographics("040"), ref("050"), usage="R"),
        party("2010BB", "PR", "Payer", "040", "1", street("020"), city("030"), ref("040"), usage="R"),
        claim_loop(),
        patient)
    provider = loop(
        "2000A", "Provider Level", "R", "010", ">1", level("20", "Provider Level"),
        seg("PRV", "Provider Specialty", "S", "020", "1", ele(1, "Provider Code", "R"), ele(2, "Qualifier", "R")),
        party("2010AA", "85", "Billing Provider", "030", "1", street("020", "R"), city("030", "R"),
              ref("040", "1", "EI SY"), seg("PER", "Contact", "S", "050", "2", ele(1, "Contact Function", "R", "IC"),
                                            ele(2, "Contact Name"), ele(3, "Number Qualifier", "R"), ele(4, "Number", "R")),
              usage="R"),
        party("2010AB", "87", "Pay-to Address", "040", "1", street("020", "R"), city("030", "R")),
        party("2010AC", "PE", "Pay-to Plan", "050", "1", street("020", "R"), city("030", "R"), ref("040", "2")),
        subscriber)
    root = envelope(
        loop("HEADER", "Table 1 - Header", "R", "010", "1", bht(),
             party("1000A", "41", "Submitter", "020", "1", contact, usage="R"),
             party("1000B", "40", "Receiver", "030", "1", usage="R")),
        loop("DETAIL", "Table 2 - Detail", "R", "020", ">1", provider))
    return Spec("ANSI837_5010_X222", VERSIONS["ANSI837_5010_X222"], "Professional Health Care Claim", root)


def acknowledgement() -> Spec:
    root = envelope(
        loop("HEADER", "Acknowledgment Header", "R", "010", "1",
             seg("AK1", "Group Response", "R", "010", "1", ele(1, "Functional Identifier", "R"), ele(2, "Group Control Number", "R")),
             loop("2000", "Set Response", "S", "020", ">1",
                  seg("AK2", "Set Response Header", "R", "010", "1", ele(1, "Set Identifier", "R"), ele(2, "Set Control Number", "R")),
                  loop("2100", "Segment Error", "S", "020", ">1",
                       seg("IK3", "Segment Note", "R", "010", "1", ele(1, "Segment ID", "R"), ele(2, "Position", "R")),
                       seg("CTX", "Segment Context", "S", "020", "10", comp(1, "Context", "R", "Name, Value")),
                       loop("2110", "Element Error", "S", "030", ">1",
                            seg("IK4", "Element Note", "R", "010", "1", comp(1, "Position", "R", "Element, Component"),
                                ele(3, "Error Code", "R")))),
                  seg("IK5", "Set Response Trailer", "S", "030", "1", ele(1, "Acknowledgment Code", "R", "A E M R W X"))),
             seg("AK9", "Group Response Status", "S", "030", "1", ele(1, "Acknowledgment Code", "R", "A E P R"),
                 ele(2, "Included Sets", "R"), ele(3, "Received Sets", "R"), ele(4, "Accepted Sets", "R"))))
    return Spec("ANSI837_5010_X231", VERSIONS["ANSI837_5010_X231"], "Implementation Acknowledgment", root)


def _status_seg(pos: str, usage: str = "R") -> Seg:
    return seg("STC", "Status", usage, pos, ">1", comp(1, "Status", "R", "Category, Code, Entity"), ele(2, "Date", "R"),
               ele(3, "Action"), ele(4, "Amount"))


def _trace(pos: str, usage: str = "R") -> Seg:
    return seg("TRN", "Trace", usage, pos, "1", ele(1, "Trace Type", "R", "1 2"), ele(2, "Trace Number", "R"))


def claim_acknowledgement() -> Spec:
    patient = loop("2000D", "Patient Level", "S", "040", ">1", level("PT", "Patient Level"),
                   party("2100D", "QC", "Patient", "020", "1", usage="R"),
                   loop("2200D", "Claim Status", "R", "030", ">1", _trace("010"), _status_seg("020"),
                        ref("030"), date_seg("Service Date", "S", "040", "2"),
                        loop("2220D", "Line Status", "S", "050", ">1",
                             seg("SVC", "Service Line", "R", "010", "1", comp(1, "Procedure", "R", "Qualifier, Code"), ele(2, "Charge", "R")),
                             _status_seg("020"))))
    provider = loop("2000C", "Provider Level", "S", "040", ">1", level("19", "Provider Level"),
                    party("2100C", "85", "Billing Provider", "020", "1", usage="R"),
                    loop("2200C", "Provider Status", "S", "030", "1", _trace("010"), _status_seg("020", "S"), ref("030")),
                    patient)
    receiver = loop("2000B", "Receiver Level", "R", "040", "1", level("21", "Receiver Level"),
                    party("2100B", "41", "Information Receiver", "020", "1", usage="R"),
                    loop("2200B", "Receiver Status", "R", "030", "1", _trace("010"), _status_seg("020"),
                         seg("QTY", "Quantity", "S", "030", "2", ele(1, "Qualifier", "R"), ele(2, "Quantity", "R")),
                         seg("AMT", "Amount", "S", "040", "2", ele(1, "Qualifier", "R"), ele(2, "Amount", "R"))),
                    provider)
    source = loop("2000A", "Source Level", "R", "010", "1", level("20", "Source Level"),
                  party("2100A", "PR AY", "Information Source", "020", "1", usage="R"),
                  loop("2200A", "Transmission Receipt", "R", "030", "1", _trace("010"), date_seg("Date", "R", "020", "2")),
                  receiver)
    root = envelope(loop("HEADER", "Table 1 - Header", "R", "010", "1", bht()),
                    loop("DETAIL", "Table 2 - Detail", "R", "020", ">1", source))
    return Spec("ANSI277_5010_X214", VERSIONS["ANSI277_5010_X214"], "Health Care Claim Acknowledgment", root)


def eligibility_response() -> Spec:
    benefit = loop("2110C", "Benefit", "S", "070", ">1",
                   seg("EB", "Benefit Information", "R", "010", "1", ele(1, "Benefit Code", "R")),
                   date_seg("Benefit Date", "S", "020", "20"),
                   seg("LS", "Loop Header", "S", "030", "1", ele(1, "Loop Identifier", "R")),
                   party("2120C", "P3 PR SK", "Benefit Related Entity", "040", "1", street("020"), city("030")),
                   seg("LE", "Loop Trailer", "S", "050", "1", ele(1, "Loop Identifier", "R")))
    subscriber = loop("2000C", "Subscriber Level", "S", "030", ">1", level("22", "Subscriber Level"), _trace("020", "S"),
                      party("2100C", "IL", "Subscriber", "030", "1", ref("020"), street("030"), city("040"),
                            demographics("050"), date_seg("Subscriber Date", "S", "060", "9"), benefit, usage="R"))
    root = envelope(
        bht(),
        loop("2000A", "Source Level", "R", "020", ">1", level("20", "Source Level"),
             party("2100A", "PR 2B GP", "Information Source", "020", "1", usage="R"),
             loop("2000B", "Receiver Level", "S", "030", ">1", level("21", "Receiver Level"),
                  party("2100B", "1P FA 80", "Information Receiver", "020", "1", ref("020"), usage="R"),
                  subscriber)))
    return Spec("ANSI271_4010_X092", VERSIONS["ANSI271_4010_X092"], "Eligibility Response", root)


def all_specs() -> dict[str, Spec]:
    specs = (professional_claim(), acknowledgement(), claim_acknowledgement(), eligibility_response())
    return {s.spec_id: s for s in specs}
