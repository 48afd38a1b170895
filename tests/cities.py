"""Invented places with weights: shared stems, an apostrophe, non-ASCII, one entry the start of another."""

CITIES = [
    ("Actalu", 7259), ("Aclune", 2822), ("Afmese", 15817), ("Agpiluri", 11721),
    ("Alvevedo", 46341), ("Alneme", 22335), ("Annese", 57295), ("Anstone", 51667),
    ("Andone", 5480), ("Apvovo", 26032), ("Arstomedo", 54438), ("Aslulu Luvo", 1620),
    ("Asnelu", 34309), ("Avdofise", 8257), ("Avgradovo", 1930), ("Canesto", 63207),
    ("Cagralugra", 12996), ("Canevo", 1362), ("Capise", 20592), ("Cafisto", 18921),
    ("Casalvento di Nerpi", 1152), ("Cavomese", 36577), ("Catafi", 38915),
    ("Castelvarro di Sumba", 17342), ("Cabanene", 72639), ("Castopi", 43776),
    ("Calva de' Torvi", 3375), ("Cedolulu", 10474), ("Cebaba", 48972), ("Chseve", 4022),
    ("Chgrata", 1053), ("Civome Dofi", 32134), ("Cigraseba", 2340),
    ("Cosenegra", 1013), ("Covo", 41322), ("Covorime", 24149), ("Crvobane", 30024),
    ("Crfita", 14379), ("Cupiba", 6334), ("Forvù", 60209), ("Mistose", 86251),
    ("Nastone", 82749), ("Pagraba", 75926), ("Quorva Sant'Irmo", 27987),
    ("Reglio Cavara", 69441), ("Reglio Esina", 66283), ("Rovove", 89839),
    ("San Telvio", 4727), ("Sanvero", 9326), ("Tuvone", 79311),
]

# prefix, case-sensitive, the heaviest five
BEST_FIVE = [
    ("", True, ["Rovove", "Mistose", "Nastone", "Tuvone", "Pagraba"]),
    ("C", True, ["Cabanene", "Canesto", "Cebaba", "Castopi", "Covo"]),
    ("Ca", True, ["Cabanene", "Canesto", "Castopi", "Catafi", "Cavomese"]),
    ("San", True, ["Sanvero", "San Telvio"]),
    ("Reglio", True, ["Reglio Cavara", "Reglio Esina"]),
    ("Forvù", True, ["Forvù"]),
    ("a", True, []),
    ("Rovem", True, []),
    ("CovoCovorime", True, []),
    ("a", False, ["Annese", "Arstomedo", "Anstone", "Alvevedo", "Asnelu"]),
    ("SAN", False, ["Sanvero", "San Telvio"]),
    ("reglio", False, ["Reglio Cavara", "Reglio Esina"]),
    ("FORVù", False, ["Forvù"]),
]
