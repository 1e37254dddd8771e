"""Fixed values that the tests share."""

SF_SMALL = "/root/testdata/sf0.001"

# A small raw report: only the line format is the source's, every ad is made up.
RAW_REPORT = """https://ss.lv/msg/lv/real-estate/flats/testa-nov/ezerpils/q1a2z.html
Pilsēta, rajons:><b>Testa nov.
Pilsēta/pagasts:><b>Ezerpils
Iela:><b>Bērzu gatve 21
Istabas:>3
Platība:>71.3 m²
Stāvs:>2/6
Sērija:>Jaun.
Price:>88 250 € (1 237.73 €/m²)
Date:>09.11.2024
https://ss.lv/msg/lv/real-estate/flats/testa-nov/ezerpils/w3s4x.html
Pilsēta, rajons:><b>Testa nov.
Iela:><b>Ozolu pr.7
Istabas:>4
Platība:>96.45 m²
Stāvs:>5/8/lifts
Mājas tips:>Koka
Price:>131 000 € (1 358.22 €/m²)
Date:>22.10.2024
https://ss.lv/msg/lv/real-estate/flats/testa-nov/ezerpils/e5d6c.html
Iela:><b>Kļavu 30
Istabas:>1
Platība:>33 m²
Stāvs:>1.00/4
Price:>2 450 000 € (74 242.42 €/m²)
Date:>08.11.2024
https://ss.lv/msg/lv/real-estate/flats/testa-nov/ezerpils/r7f8v.html
Iela:><b>Liepu 2
Istabas:>2
Platība:>48 m²
Stāvs:>3/3
Date:>07.11.2024
https://ss.lv/msg/lv/real-estate/flats/testa-nov/ezerpils/t9g0b.html
Iela:><b>Priežu iel.15
Istabas:>2
Platība:>52 m²
Stāvs:>4/7
Price:>61300 €
Date:>30.09.2024
"""
