"""Small hand-made inputs in the raw layouts the run reads."""

from __future__ import annotations

import os

from arrivals_mart.contracts import ARRIVALS_INPUT

ARRIVAL_COLUMNS = [f.name for f in ARRIVALS_INPUT.fields]


def arrival(cicid, port="NYC", arrdate=20574.0, mode=1.0, visa=2.0, dtadfile="20160430", admnum=92736214533.0,
            mon=4.0, res=582.0, addr="NY"):
    row = dict.fromkeys(ARRIVAL_COLUMNS)
    row.update(
        cicid=cicid, i94yr=2016.0, i94mon=mon, i94cit=582.0, i94res=res, i94port=port, arrdate=arrdate,
        i94mode=mode, i94addr=addr, depdate=arrdate + 7 if arrdate is not None else None, i94bir=40.0,
        i94visa=visa, count=1.0, dtadfile=dtadfile, visapost="MEX", occup=None, entdepa="G", entdepd="O",
        entdepu=None, matflag="M", biryear=1976.0, dtaddto="20161026", gender="F", insnum=None,
        airline="AM", admnum=admnum, fltno="00410", visatype="B2",
    )
    return tuple(row[c] for c in ARRIVAL_COLUMNS)


ARRIVALS = [
    arrival(1.0),
    arrival(2.0, port="  NYC ", mode=None, visa=1.0),
    arrival(3.0, port="LOS", mode=0.0, visa=3.0, arrdate=20575.0, dtadfile="D/S"),
    arrival(4.0, port="LOS", mode=9.0, visa=None, arrdate=None, dtadfile=None, res=101.0, addr="CA"),
    arrival(5.0, port="SFR", mode=2.0, visa=9.0, arrdate=float("nan"), res=999.0, addr=None),
    arrival(6.0, port="SFR", mode=3.0, visa=2.0, arrdate=3e12, mon=5.0),
]

AIRPORTS_CSV = (
    "ident,type,name,elevation_ft,continent,iso_country,iso_region,municipality,gps_code,iata_code,local_code,coordinates\r\n"
    'X1,heliport, Pier Nine Heliport ,7,NA,US,US-NY,Harbour Town,X1,, NYC ,"-70.10, 41.20"\r\n'
    'X22,small_airport,Two Oaks Strip,812,NA,US,US-CA,Two Oaks,X22,,LOS,"-118.30, 34.40"\r\n'
    'X22,small_airport,Two Oaks Strip,812,NA,US,US-CA,Two Oaks,X22,,LOS,"-118.30, 34.40"\r\n'
    'X333,small_airport,Gravel Bar Field,95,NA,US,US-WA,Gravel Bar,X333,,,"-122.50, 47.60"\r\n'
)

DEMOGRAPHICS_CSV = (
    "City;State;Median Age;Male Population;Female Population;Total Population;Number of Veterans;"
    "Foreign-born;Average Household Size;State Code;Race;Count\n"
    "New York;New York;36.0;4000;4500;8500;100;3000;2.5;NY;White;10\n"
    "New York;New York;36.0;4000;4500;8500;100;3000;2.5;NY;Asian;20\n"
    "Buffalo;New York;33.0;100;120;220;x;50;2.0;NY;White;5\n"
    "Los Angeles;California;35.0;2000;2100;4100;80;1500;3.0;CA;White;7\n"
)

TEMPERATURES_CSV = (
    "dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,Latitude,Longitude\n"
    "1743-11-01,6.0,1.0,Mexico City,Mexico,19.4N,99.1W\n"
    "1743-12-01,8.0,3.0,Mexico City,Mexico,19.4N,99.1W\n"
    "1744-01-01,,,Tirana,Albania,41.3N,19.8E\n"
    "1744-02-01,4.0,1.0,Atlantis,Atlantis,0N,0E\n"
)

COUNTRIES_CSV = "country_code,country\n582,Mexico\n101,Albania\n316,Algeria\n"


def write_inputs(spark, root: str, arrivals=ARRIVALS) -> str:
    os.makedirs(root, exist_ok=True)
    spark.createDataFrame(arrivals, ARRIVALS_INPUT).coalesce(2).write.parquet(f"{root}/sas_data")
    for name, text in {
        "airport-codes_csv.csv": AIRPORTS_CSV,
        "us-cities-demographics.csv": DEMOGRAPHICS_CSV,
        "GlobalLandTemperaturesByCity.csv": TEMPERATURES_CSV,
        "country_code.csv": COUNTRIES_CSV,
    }.items():
        with open(f"{root}/{name}", "w", newline="") as f:
            f.write(text)
    return root
