"""Service names, code labels and distance bands of the trip model."""

SERVICIOS = ("yellow", "green")

FORMA_PAGO = {
    1: "tarjeta",
    2: "efectivo",
    3: "sin_cargo",
    4: "disputa",
    5: "desconocido",
    6: "viaje_anulado",
}
FORMA_PAGO_RESTO = "no_informado"

FORMA_PAGO_TARIFA = {
    1: "tarjeta",
    2: "efectivo",
    3: "sin_cargo",
    4: "disputa",
    0: "sin_dato (0)",
}
FORMA_PAGO_TARIFA_RESTO = "otro"

TIPO_TARIFA = {
    1: "1 estandar",
    2: "2 JFK",
    3: "3 Newark",
    4: "4 Nassau/Westchester",
    5: "5 negociada",
    6: "6 grupal",
}
TIPO_TARIFA_RESTO = "99 desconocida"

PLATAFORMA = {"HV0003": "Uber", "HV0005": "Lyft"}
PLATAFORMA_RESTO = "otras plataformas"
SIN_PLATAFORMA = "sin plataforma"

# (upper bound, label); the last band is open.
RANGO_DISTANCIA = (
    (1, "1) < 1 mi"),
    (2, "2) 1-2 mi"),
    (5, "3) 2-5 mi"),
    (10, "4) 5-10 mi"),
    (20, "5) 10-20 mi"),
)
RANGO_DISTANCIA_RESTO = "6) 20+ mi"

DIAS = ("1 Lun", "2 Mar", "3 Mie", "4 Jue", "5 Vie", "6 Sab", "7 Dom")

ZONAS_EXCLUIDAS = ("N/A", "Outside of NYC")

SIN_TAXIMETRO = "sin taximetro (codigo 0)"
CON_TAXIMETRO = "con taximetro"
