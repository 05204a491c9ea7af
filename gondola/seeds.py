"""Fixed values that must equal the original rule data for the same results on real catalog data.

They are kept here plainly, in their original order, and are passed to the operators as
parameters. (Stand-in rules for the fixture tables live in ``gondola.schemas``.)
"""

# --- Fixed values: keyword rules of the initial classification (category -> keywords), in order.
GROCERY_KEYWORDS = {
    "arroz": ["arroz"],
    "aceite": ["aceite"],
    "fideos": ["fideos", "pasta ", "tallar", "spaghetti", "espagueti"],
    "leche": ["leche"],
    "yerba": ["yerba"],
    "azucar": ["azucar", "azúcar"],
    "jabon": ["jabon", "jabón", "detergente"],
    "galletitas": ["galleta", "galletita"],
    "pan": ["pan lactal", "pan de mi", "panificad"],
    "cafe": ["cafe ", "café", "nescafe"],
    "te": ["te en saq", "te herbal", "infusion"],
    "gaseosa": ["gaseosa", "coca", "pepsi", "sprite", "fanta"],
    "agua": ["agua mineral", "agua sin gas", "agua con gas"],
    "jugo": ["jugo", "zumo"],
    "cerveza": ["cerveza"],
    "vino": ["vino "],
    "manteca": ["manteca", "margarina"],
    "queso": ["queso"],
    "yogur": ["yogur", "yoghurt"],
    "harina": ["harina"],
}

# --- Fixed values: target neighbourhoods / localities of the price feed.
TARGET_AREAS = ["monserrat", "once", "balvanera"]
TARGET_LOCALITIES = ["ciudad autónoma de buenos aires", "ciudad autonoma de buenos aires", "capital federal"]

# --- Fixed values: stop words of the cluster-coherence word count (words of 4+ letters).
COHERENCE_STOPWORDS = [
    "para", "con", "sin", "pack", "grms", "litro", "botella", "caja",
    "bolsa", "pote", "frasco", "lata", "sobre", "unidad", "unidades",
    "carrefour", "marca", "precio", "gran", "compra", "clasico", "classic",
    "sabor", "saborizada", "natural", "original",
]

# --- Fixed values: stop words of n-gram mining (an n-gram holding any of them is dropped).
NGRAM_STOPWORDS = [
    "con", "sin", "para", "por", "del", "los", "las", "una", "uno", "que",
    "pack", "caja", "bolsa", "pote", "frasco", "lata", "sobre", "botella",
    "gramos", "grs", "litros", "lts", "unidades", "uni", "kilos",
    "grm", "grs", "mlt", "bot", "lat", "sob", "paq", "doy", "fco",
    "marca", "precio", "gran", "compra", "essential", "selection",
    "clasico", "classic", "original", "sabor", "saborizada", "natural",
    "premium", "super", "extra", "light", "diet", "zero",
    "carrefour", "coto", "jumbo", "disco", "walmart", "libertad",
    "arcor", "nestle", "bimbo", "molinos", "marolio", "glutano",
    "la", "serenisima", "sancor", "ilolay", "tregar", "milkaut",
    "coca", "cola", "pepsi", "fanta", "sprite", "quilmes", "brahma",
    "dos", "anclas", "alicante", "natura", "knorr", "maggi",
    "colgate", "dove", "pantene", "sedal", "head", "shoulders",
    "johnson", "nivea", "rexona", "axe", "skip", "ala", "magistral",
    "ayudin", "procenex", "poett", "lysoform", "glade", "blem",
    "tex", "home", "basic", "detroit", "arco", "iris",
    "bon", "key", "kolor", "zed", "black", "sensodyne", "oral",
    "lays", "krachitos", "nikitos", "pringles",
    "silver", "shadow", "siempre", "libre", "moto", "saint", "gottard",
    "producto", "articulo", "item",
]

# --- Fixed values: brands filtered from n-gram mining v2 ('_' joins multi-word brands).
BRANDS = [
    "carrefour", "coto", "jumbo", "disco", "dia", "arcor", "nestle", "kraft", "bimbo",
    "molinos", "dos_anclas", "marolio", "colgate", "dove", "pantene", "sedal", "nivea",
    "rexona", "gillette", "oral_b", "tex", "home", "detroit", "coca_cola", "pepsi",
    "quilmes", "brahma", "stella_artois", "ser", "sancor", "la_serenisima", "ilolay",
    "milkaut", "tregar", "dan", "cindor", "la_virginia", "taragui", "rosamonte",
    "nescafe", "dolca", "terrabusi", "bagley", "toddy", "savora", "hellmanns",
    "natura", "knorr", "ades", "ser", "silver_shadow", "siempre_libre", "moto",
    "saint_gottard", "san_remo", "dog_chow", "top_life", "pedigree", "whiskas",
    "catit", "excellent", "vital_can", "old_prince", "samsung", "lg", "philips",
    "xiaomi", "motorola", "nokia", "huawei",
]

# --- Fixed values: unit / format patterns (substring test) of n-gram mining v2.
UNIT_PATTERNS = [
    "x grs", "x gr", "x g", "x ml", "x cc", "x cm", "x kg", "x uni", "x u", "x lt", "x l",
    "bot ml", "paq grm", "paq gr", "bsa gr", "cja gr", "ml bot", "fco gr", "pot gr",
    "g paq", "g bsa", "g cja", "g pot", "g fco", "g doy",
    "ml aer", "cc bot", "x x", "s e", "pet x", "doy gr",
    "grm", "grs", "ml", "cc", "kg", "lt", "uni", "bot", "paq", "bsa", "cja", "fco", "pot",
    "aer", "sch", "doy", "fwp", "env",
]

# --- Fixed values: connector words that disqualify a bigram in n-gram mining v2.
CONNECTORS = ["x", "de", "con", "sin", "en", "el", "la", "un", "una"]

# --- Fixed values: probe words of the cluster keyword count.
PROBE_KEYWORDS = [
    "agua", "leche", "yogur", "queso", "pan", "arroz", "aceite",
    "jabon", "shampoo", "detergente", "limpiador", "papel", "vino",
    "cerveza", "jugo", "gaseosa", "carne", "pollo", "chocolate",
    "alfajor", "galletitas", "fideos", "yerba", "cafe", "te",
    "papa", "tomate", "cebolla", "manzana", "banana", "naranja",
]
