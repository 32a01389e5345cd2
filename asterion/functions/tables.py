"""Published constants that results depend on.

Everything in this module is data. Nothing here is code that computes.
"""

# -- Fixed values: offsets from a photometric band to V --------------------------
BAND_TO_V = {
    "V": 0.0, "v": 0.0, "B": -0.8, "U": -1.3, "R": 0.4, "I": 0.8,
    "g": -0.35, "r": 0.14, "i": 0.32, "z": 0.26, "y": 0.32, "u": 2.5,
    "w": -0.13, "c": -0.05, "o": 0.33, "G": 0.28,
    "J": 1.2, "H": 1.4, "K": 1.7, "C": 0.4, "W": 0.4, "L": 0.2, "Y": 0.7,
    "": -0.8,
}
# Two-character codes accepted in addition where the input is already ADES.
BAND_TO_V_ADES = {"Ao": 0.33, "Ac": -0.05, "Pw": -0.13, "Pi": 0.32}

# -- Fixed values: orbit classes -------------------------------------------------
# code: (short name, long name), in display order
ORBIT_CLASSES = {
    0: ("Atira", "Atira"),
    1: ("Aten", "Aten"),
    2: ("Apollo", "Apollo"),
    3: ("Amor", "Amor"),
    9: ("InOther", "Inner Other"),
    10: ("Mars-X", "Mars Crosser"),
    11: ("MB", "Main Belt"),
    12: ("JT", "Jupiter Trojan"),
    19: ("MidOther", "Middle Other"),
    20: ("JupCoup", "Jupiter Coupled"),
    21: ("NepTr", "Neptune Trojan"),
    22: ("Centaur", "Centaur"),
    23: ("TNO", "TNO"),
    30: ("Hyper", "Hyperbolic"),
    31: ("Para", "Parabolic"),
    99: ("Other", "Other (Unusual)"),
}
UNCLASSIFIED = ("Unclass", "Unclassified")

# code: (short name, long name, coarse group), in display order
EXTENDED_CLASSES = {
    0: ("Atira", "Atira", "NEO"),
    1: ("Aten", "Aten", "NEO"),
    2: ("Apollo", "Apollo", "NEO"),
    30: ("NrAmor", "Near Amor", "NEO"),
    31: ("FrAmor", "Distant Amor", "NEO"),
    9: ("InOther", "Inner Other", "NEO"),
    10: ("Mars-X", "Mars Crosser", "Mars Crosser"),
    110: ("Hung", "Hungaria", "Main Belt"),
    111: ("IMB", "Inner Main Belt", "Main Belt"),
    112: ("MMB", "Middle Main Belt", "Main Belt"),
    113: ("OMB", "Outer Main Belt", "Main Belt"),
    12: ("JT", "Jupiter Trojan", "Jupiter Region"),
    19: ("MidOther", "Middle Other", "Jupiter Region"),
    20: ("JupCoup", "Jupiter Coupled", "Jupiter Region"),
    21: ("NepTr", "Neptune Trojan", "Outer Solar System"),
    22: ("Centaur", "Centaur", "Outer Solar System"),
    23: ("TNO", "TNO", "Outer Solar System"),
    300: ("Hyper", "Hyperbolic", "Hyperbolic/Parabolic"),
    310: ("Para", "Parabolic", "Hyperbolic/Parabolic"),
    99: ("Other", "Other (Unusual)", "Unclassified"),
}
COARSE_ORDER = [
    "NEO", "Mars Crosser", "Main Belt", "Jupiter Region",
    "Outer Solar System", "Hyperbolic/Parabolic", "Unclassified",
]

# Semi-major axes and limits in au.
JUPITER_A = 5.2026
JUPITER_A_PRECISE = 5.20336301
NEPTUNE_A = 30.069
MAIN_BELT_OUTER = 3.27831
HUNGARIA_OUTER = 2.06
INNER_BELT_OUTER = 2.50
MIDDLE_BELT_OUTER = 2.82
AMOR_SPLIT_Q = 1.15

# -- Fixed values: one-character codes of the 80-column format to ADES names -----
CATALOGS = {
    "a": "USNOA1", "b": "USNOSA1", "c": "USNOA2", "d": "USNOSA2", "e": "UCAC1",
    "f": "Tycho1", "g": "Tycho2", "h": "GSC1.0", "i": "GSC1.1", "j": "GSC1.2",
    "k": "GSC2.2", "l": "ACT", "m": "GSCACT", "n": "SDSSDR8", "o": "USNOB1",
    "p": "PPM", "q": "UCAC4", "r": "UCAC2", "s": "USNOB2", "t": "PPMXL",
    "u": "UCAC3", "v": "NOMAD", "w": "CMC14", "x": "Hip2", "y": "Hip", "z": "GSC",
    "A": "AC", "B": "SAO1984", "C": "SAO", "D": "AGK3", "E": "FK4", "F": "ACRS",
    "G": "LickGas", "H": "Ida93", "I": "Perth70", "J": "COSMOS", "K": "Yale",
    "L": "2MASS", "M": "GSC2.3", "N": "SDSSDR7", "O": "SSTRC1", "P": "MPOSC3",
    "Q": "CMC15", "R": "SSTRC4", "S": "URAT1", "T": "URAT2", "U": "Gaia1",
    "V": "Gaia2", "W": "Gaia3", "X": "Gaia3E", "Y": "UCAC5", "Z": "ATLAS2",
    "0": "IHW", "1": "PS1DR1", "2": "PS1DR2", "3": "GaiaInt", "4": "GZ",
    "5": "UBAD", "6": "Gaia16",
}
MODES = {
    "C": "CCD", "B": "CMO", "V": "VID", "T": "TDI", "P": "PHO", "E": "ENC",
    "M": "MIC", "e": "PMT", "O": "OCC", "A": "PHO", "N": "PHO", " ": "PHO",
    "S": "CCD", "s": "CCD", "X": "CCD", "x": "CCD",
}
BANDS = {
    "B": "Bj", "V": "Vj", "R": "Rc", "I": "Ic", "J": "J", "H": "H", "K": "K",
    "U": "Uj", "W": "W", "G": "G", "g": "Sg", "r": "Sr", "i": "Si", "z": "Sz",
    "w": "Pw", "y": "Py", "o": "Ao", "c": "Ac", "C": "CV", "L": "CV", "T": "Gr",
}

# -- Fixed values: observatory code to survey project ----------------------------
STATION_PROJECTS = {
    "704": "LINEAR", "G45": "LINEAR", "P07": "LINEAR",
    "566": "NEAT", "608": "NEAT", "644": "NEAT",
    "691": "Spacewatch", "291": "Spacewatch",
    "699": "LONEOS",
    "703": "Catalina Survey", "E12": "Catalina Survey", "G96": "Catalina Survey",
    "I52": "Catalina Survey", "V06": "Catalina Survey", "G84": "Catalina Survey",
    "693": "Catalina Survey",
    "V00": "Bok NEO Survey",
    "F51": "Pan-STARRS", "F52": "Pan-STARRS",
    "C51": "NEOWISE",
    "T05": "ATLAS", "T07": "ATLAS", "T08": "ATLAS", "T03": "ATLAS",
    "M22": "ATLAS", "W68": "ATLAS", "R17": "ATLAS",
    "X05": "Rubin/LSST",
    "I41": "Other-US", "U68": "Other-US", "U74": "Other-US", "W84": "Other-US",
    "675": "Palomar Mountain",
}

# -- Fixed values: series of the Moon's ecliptic longitude and latitude ----------
# (D, M, M', F, amplitude in degrees)
MOON_LONGITUDE_TERMS = [
    (0, 0, 1, 0, 6.288774), (2, 0, -1, 0, 1.274027), (2, 0, 0, 0, 0.658314),
    (0, 0, 2, 0, 0.213618), (0, 1, 0, 0, -0.185116), (0, 0, 0, 2, -0.114332),
    (2, 0, -2, 0, 0.058793), (2, -1, -1, 0, 0.057066), (2, 0, 1, 0, 0.053322),
    (2, -1, 0, 0, 0.045758),
]
MOON_LATITUDE_TERMS = [
    (0, 0, 0, 1, 5.128122), (0, 0, 1, 1, 0.280602), (0, 0, 1, -1, 0.277693),
    (2, 0, 0, -1, 0.173237), (2, 0, -1, 1, 0.055413), (2, 0, -1, -1, 0.046271),
    (2, 0, 0, 1, 0.032573), (0, 0, 2, 1, 0.017198),
]
SYNODIC_MONTH_DAYS = 29.5306
REFERENCE_FULL_MOON = "2000-01-21 04:40:00"

# -- Fixed values: rotation from galactic to equatorial axes, and obliquity ------
GALACTIC_POLE = (-0.867666136, -0.198076390, 0.455983776)
OBLIQUITY_J2000 = 23.43929111

# -- Fixed values: cumulative number of near-Earth objects brighter than H -------
POPULATION_MODEL = {
    15.00: 50, 16.00: 130, 17.00: 430, 17.75: 936, 18.00: 1_100, 19.00: 2_600,
    19.75: 4_550, 20.00: 5_500, 20.37: 7_300, 21.00: 11_000, 21.75: 16_000,
    22.00: 20_000, 22.25: 24_000, 22.75: 30_000, 23.00: 38_000, 24.00: 130_000,
    24.75: 290_000, 25.00: 380_000, 25.37: 500_000, 26.00: 1_200_000,
    27.00: 3_800_000, 27.75: 9_120_000, 28.00: 12_000_000,
}

# -- Fixed values: paths inside the orbit JSON document --------------------------
ORBIT_JSON_FIELDS = {
    "orbit_quality": ("$.orbit_fit_statistics.orbit_quality", "string"),
    "snr": ("$.orbit_fit_statistics.SNR", "double"),
    "arc_length": ("$.orbit_fit_statistics.arc_length", "string"),
    "normalized_rms": ("$.orbit_fit_statistics.normalized_RMS", "double"),
    "mars_moid": ("$.moid_data.Mars", "double"),
    "venus_moid": ("$.moid_data.Venus", "double"),
    "jupiter_moid": ("$.moid_data.Jupiter", "double"),
    "orbit_type_str": ("$.categorization.orbit_type_str", "string"),
    "g1": ("$.magnitude_data.G1", "double"),
    "g2": ("$.magnitude_data.G2", "double"),
    "g12": ("$.magnitude_data.G12", "double"),
}

# -- Fixed values: digits of the packed designation alphabet ---------------------
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

# -- Fixed values: ADES optical fields -------------------------------------------
# element order of the full row form, with the source column where it differs
ADES_OPTICAL_ROW = [
    "permID", "provID", "trkSub", "obsID", "trkID", "trkMPC", "mode", "stn",
    "sys", "ctr", "pos1", "pos2", "pos3", "prog", "obsTime", "rmsTime", "ra",
    "dec", "rmsRA", "rmsDec", "rmsCorr", "astCat", "mag", "rmsMag", "band",
    "photCat", "photAp", "logSNR", "seeing", "exp", "rmsFit", "nStars", "ref",
    "disc", "subFmt", "precTime", "precRA", "precDec", "notes", "remarks",
    "uncTime",
]
# element order of the exchange form
ADES_OPTICAL_EXPORT = [
    "permID", "provID", "trkSub", "obsID", "obsSubID", "trkID", "trkMPC", "mode",
    "stn", "prog", "obsTime", "rmsTime", "ra", "dec", "rmsRA", "rmsDec",
    "rmsCorr", "astCat", "mag", "rmsMag", "band", "disc", "notes", "remarks",
]
ADES_DECIMALS = {"ra": 6, "dec": 6, "rmsRA": 3, "rmsDec": 3, "rmsCorr": 3,
                 "rmsTime": 3, "mag": 2}
# column and width of the pipe-separated form
PSV_COLUMNS = [
    ("permID", 7), ("provID", 11), ("trkSub", 8), ("mode", 3), ("stn", 4),
    ("obsTime", 25), ("ra", 12), ("dec", 12), ("rmsRA", 7), ("rmsDec", 7),
    ("rmsCorr", 7), ("astCat", 8), ("mag", 6), ("band", 3), ("disc", 1),
    ("prog", 4), ("notes", 5),
]
ADES_VERSION = "2022"
