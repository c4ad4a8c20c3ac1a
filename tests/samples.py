"""Document texts for the tests, written from scratch."""

NS = "http://www.sii.cl/SiiDte"


def line(number=1, name="Item", qty="1", price="100", amount="100", more=""):
    def tag(t, v):
        return "" if v is None else f"<{t}>{v}</{t}>"

    return (f"<Detalle>{tag('NroLinDet', number)}{tag('NmbItem', name)}{more}{tag('QtyItem', qty)}"
            f"{tag('PrcItem', price)}{tag('MontoItem', amount)}</Detalle>")


def document(folio, lines, net=100, tax=19, total=119, tipo=33, day="2025-10-20", issuer="11111111-1", name="EMISOR SA",
             attr=' ID="D"', receiver_name="<RznSocRecep>RECEPTOR SPA</RznSocRecep>", issuer_name=None):
    issuer_name = f"<RznSoc>{name}</RznSoc>" if issuer_name is None else issuer_name
    money = "" if net is None else f"<MntNeto>{net}</MntNeto>"
    return (f"<Documento{attr}><Encabezado><IdDoc><TipoDTE>{tipo}</TipoDTE><Folio>{folio}</Folio><FchEmis>{day}</FchEmis></IdDoc>"
            f"<Emisor><RUTEmisor>{issuer}</RUTEmisor>{issuer_name}</Emisor><Receptor><RUTRecep>22222222-2</RUTRecep>{receiver_name}</Receptor>"
            f"<Totales>{money}<TasaIVA>19.00</TasaIVA><IVA>{tax}</IVA><MntTotal>{total}</MntTotal></Totales></Encabezado>{''.join(lines)}</Documento>")


def envelope(*documents, ns=f' xmlns="{NS}"', prolog='<?xml version="1.0" encoding="UTF-8"?>\n'):
    inner = "".join(f'<DTE version="1.0">{d}</DTE>' for d in documents)
    return f'{prolog}<EnvioDTE{ns} version="1.0"><SetDTE ID="S"><Caratula version="1.0"><RutEmisor>1-9</RutEmisor></Caratula>{inner}</SetDTE></EnvioDTE>\n'


def prefixed(text, prefix="sii"):
    import re

    body = re.sub(r"<(/?)([A-Za-z])", rf"<\1{prefix}:\2", text)
    return body.replace("xmlns=", f"xmlns:{prefix}=")


VALID = envelope(document(10001, [line(1, "Item A", "2.000000", "10000.000000", 20000), line(2, "Item B", "1.000000", "5000.000000", 5000)],
                          net=25000, tax=4750, total=29750))
FAULTY = envelope(document(10002, [line(1, "Item A", "2", "10000", 20000), line(2, "Item B", "1", "5000", 5500)],
                           net=24000, tax=4200, total=28200))
BARE = ('<?xml version="1.0" encoding="ISO-8859-1"?>\n'
        + document(1001, [line(1, "Ítem Ñ", "2", "50", 120)], attr="", day="2025-10-14"))
