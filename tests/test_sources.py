from decimal import Decimal as D

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from cargoline.schema import DELIVERY_SCHEMA
from cargoline.sources.csv import read_csv, read_deliveries

HEADER = "pais,fecha_proceso,transporte,ruta,tipo_entrega,material,precio,cantidad,unidad\n"


def _file(tmp_path, text, name="in.csv"):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_typed_scan_edge_cases(spark, tmp_path):
    body = (
        'GT,20250307,T1,R1,ZPRE,,1.5,2,ST\n'            # empty field -> NULL
        'GT,20250307,T1,R1,ZPRE,"",1.5,2,ST\n'          # quoted empty -> NULL
        'GT,20250307,T1,R1,ZPRE,"""""",1.5,2,ST\n'      # -> the text ""
        'GT,20250307,T1,R1,ZPRE, x ,1.5,2,ST\n'         # spaces kept
        'GT,20250307,T1,R1,ZPRE,"a\nb",1.5,2,ST\n'      # embedded newline kept
        'GT,20250307,T1,R1,ZPRE,m,abc,2,ST\n'           # bad decimal -> NULL, row kept
        'GT,20250307,T1,R1,ZPRE,m2,1.5,2,ST,extra\n'    # extra field dropped
        'GT,20250307,T1,R1,ZPRE,m3\n'                   # short row padded
        'GT,20250307,T1,R1,ZPRE,m4,0E-18,1E-7,ST\n'     # exponent forms parse
    )
    df = read_deliveries(spark, _file(tmp_path, HEADER + body))
    got = [(r.material, r.precio, r.cantidad, r.unidad) for r in df.collect()]
    assert got == [
        (None, D("1.5"), D(2), "ST"),
        (None, D("1.5"), D(2), "ST"),
        ('""', D("1.5"), D(2), "ST"),
        (" x ", D("1.5"), D(2), "ST"),
        ("a\nb", D("1.5"), D(2), "ST"),
        ("m", None, D(2), "ST"),
        ("m2", D("1.5"), D(2), "ST"),
        ("m3", None, None, None),
        ("m4", D(0), D("1E-7"), "ST"),
    ]


def test_binds_by_position_unless_checked(spark, tmp_path):
    swapped = HEADER.replace("pais,fecha_proceso", "fecha_proceso,pais")
    path = _file(tmp_path, swapped + "20250307,GT,T1,R1,ZPRE,m,1,2,ST\n")
    assert read_deliveries(spark, path).collect()[0].pais == "20250307"
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_deliveries(spark, path, check_header=True).collect()


def test_inferred_schema(spark, tmp_path):
    path = _file(tmp_path, "col1,col2,col3\na,1,2.5\nb,2,3.5\n")
    df = read_csv(spark, path)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["string", "int", "double"]
    assert df.count() == 2


def test_semicolon_and_no_header(spark, tmp_path):
    path = _file(tmp_path, "a;1;2.5\nb;2;3.5\n")
    df = read_csv(spark, path, header=False, delimiter=";")
    assert df.columns == ["_c0", "_c1", "_c2"]
    assert df.count() == 2
    typed = read_csv(spark, path, header=False, delimiter=";", schema="x string, y int, z double")
    assert typed.collect()[1].z == 3.5


def test_split_reading_when_not_multiline(spark, tmp_path):
    path = _file(tmp_path, HEADER + "GT,20250307,T1,R1,ZPRE,m,1,2,ST\n" * 50)
    assert read_deliveries(spark, path, multiline=False).count() == 50
    assert read_deliveries(spark, path).schema == DELIVERY_SCHEMA


def test_inference_reads_short_t_codes_as_times(spark, tmp_path):
    """A hazard of schema inference kept as is: ``T<n>`` parses as a time of today."""
    path = _file(tmp_path, "transporte,x\nT1,1\nT5,2\n")
    df = read_csv(spark, path)
    assert df.schema["transporte"].dataType.typeName() == "timestamp"
    typed = read_csv(spark, path, schema="transporte string, x int")
    assert [r.transporte for r in typed.collect()] == ["T1", "T5"]
