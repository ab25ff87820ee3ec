"""Small documents of our own, and short ways to run them."""

from edilake.operators import framing, loops
from edilake.specs.catalog import professional_claim

SPEC = professional_claim()


def isa(control=1, version="00501"):
    return (f"ISA*00*{'':10}*00*{'':10}*ZZ*{'ACME':15}*ZZ*{'PAYER':15}*240102*0930*U*{version}*{control:09d}*0*T*:")


def gs(version="005010X222A1", fic="HC", control=7):
    return f"GS*{fic}*ACME*PAYER*20240102*0930*{control}*X*{version}"


HEAD = ["ST*837*1*005010X222A1", "BHT*0019*00*44*20240102*0930*CH", "NM1*41*2*ACME*****46*1", "PER*IC*DESK*TE*5550001",
        "NM1*40*2*PAYER*****46*2"]
PROVIDER = ["HL*1**20*1", "NM1*85*2*CLINIC*****XX*9", "N3*1 ROAD", "N4*TOWN*MD*20705", "REF*EI*12"]
SUBSCRIBER = ["HL*2*1*22*0", "SBR*P**GROUP******CI", "NM1*IL*1*POE*ANN****MI*3", "NM1*PR*2*PLAN*****PI*4"]


def claim(number, lines=1, extra=(), hi="HI*BK:1"):
    out = [f"CLM*{number}*10.00***11:B:1*Y*A*Y*Y"] + ([hi] if hi else []) + list(extra)
    for i in range(1, lines + 1):
        out += [f"LX*{i}", f"SV1*HC:{i}*5.00*UN*1", "DTP*472*D8*20240101"]
    return out


TAIL = ["SE*1*1", "GE*1*7", "IEA*1*000000001"]


def document(*groups, head=HEAD, provider=PROVIDER, subscriber=SUBSCRIBER, tail=TAIL):
    out = [isa(), gs(), *head, *provider, *subscriber]
    for g in groups:
        out += g
    return out + list(tail)


def text(segments, seg="~", ele="*", comp=":", line_break=""):
    out = seg.join(s.replace("*", "\0").replace(":", "\1") for s in segments) + seg
    return out.replace("\0", ele).replace("\1", comp).replace(seg, seg + line_break)


def raw(spark, documents):
    rows = [(k, v if isinstance(v, str) else text(v)) for k, v in documents.items()]
    return framing.as_raw(spark.createDataFrame(rows, "file_id string, content string"))


def parts(spark, documents, file_type=SPEC.spec_id):
    return framing.cut_elements(framing.cut_segments(framing.frame(raw(spark, documents), file_type)))


def locate(spark, documents, spec=SPEC, long_documents=False):
    return loops.assign_loops(parts(spark, documents, spec.spec_id), spec, long_documents)


def rows(df, *columns, order=("file_id", "pos")):
    return [tuple(r) for r in df.orderBy(*order).select(*columns).collect()]
