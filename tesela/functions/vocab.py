"""Fixed values.

These lists and maps must equal the source system's for the cleaning and
retrieval rules to give the same results. They are stated plainly, in
natural order, and are not derived from anything.
"""

from __future__ import annotations

# --- FIXED VALUES: department canonical names for contract cleaning --------
# Key: lower-cased, trimmed raw department; value: canonical spelling.
CONTRACT_DEPARTMENTS: dict[str, str] = {
    "bogota d.c.": "Bogotá D.C.",
    "bogota": "Bogotá D.C.",
    "cundinamarca": "Cundinamarca",
    "antioquia": "Antioquia",
    "valle del cauca": "Valle del Cauca",
    "atlantico": "Atlántico",
    "santander": "Santander",
    "norte de santander": "Norte de Santander",
    "tolima": "Tolima",
    "boyaca": "Boyacá",
    "cauca": "Cauca",
    "nariño": "Nariño",
    "huila": "Huila",
    "magdalena": "Magdalena",
    "bolivar": "Bolívar",
    "caldas": "Caldas",
    "risaralda": "Risaralda",
    "quindio": "Quindío",
    "meta": "Meta",
    "cesar": "Cesar",
    "la guajira": "La Guajira",
    "arauca": "Arauca",
    "putumayo": "Putumayo",
    "amazonas": "Amazonas",
    "guainia": "Guainía",
    "guaviare": "Guaviare",
    "vaupes": "Vaupés",
    "vichada": "Vichada",
    "choco": "Chocó",
    "caqueta": "Caquetá",
    "casanare": "Casanare",
    "sucre": "Sucre",
    "cordoba": "Córdoba",
}

# --- FIXED VALUES: department names for education cleaning -----------------
# Three entries of the source map are broken and are repaired here:
#   * its key " Casanare" (leading space, capital) can never match a
#     lower-cased, trimmed value; the key is "casanare" here;
#   * it maps "vichada" to "Vía"; here it maps to "Vichada";
#   * some keys exist only with accents ("caquetá", "guainía", "quindío",
#     "san andrés", "vaupés"); the unaccented spellings are accepted too.
# Unmapped values stay lower-cased (that is the source rule, kept).
EDUCATION_DEPARTMENTS: dict[str, str] = {
    "amazonas": "Amazonas",
    "antioquia": "Antioquia",
    "arauca": "Arauca",
    "atlantico": "Atlántico",
    "bogota": "Bogotá D.C.",
    "bogota d.c.": "Bogotá D.C.",
    "bolivar": "Bolívar",
    "boyaca": "Boyacá",
    "caldas": "Caldas",
    "caquetá": "Caquetá",
    "casanare": "Casanare",
    "cauca": "Cauca",
    "cesar": "Cesar",
    "choco": "Chocó",
    "cundinamarca": "Cundinamarca",
    "guainía": "Guainía",
    "guaviare": "Guaviare",
    "huila": "Huila",
    "la guajira": "La Guajira",
    "magdalena": "Magdalena",
    "meta": "Meta",
    "nariño": "Nariño",
    "norte de santander": "Norte de Santander",
    "putumayo": "Putumayo",
    "quindío": "Quindío",
    "risaralda": "Risaralda",
    "san andrés": "San Andrés",
    "santander": "Santander",
    "sucre": "Sucre",
    "tolima": "Tolima",
    "valle del cauca": "Valle del Cauca",
    "vaupés": "Vaupés",
    "vichada": "Vichada",
}
EDUCATION_DEPARTMENT_ALIASES: dict[str, str] = {
    "caqueta": "Caquetá",
    "guainia": "Guainía",
    "quindio": "Quindío",
    "san andres": "San Andrés",
    "vaupes": "Vaupés",
}

# --- FIXED VALUES: department words looked for in a question ---------------
# Substring match on the lower-cased question; "valle" stands for
# "valle del cauca", and "cauca" also fires inside "valle del cauca".
QUESTION_DEPARTMENTS: list[str] = [
    "amazonas", "antioquia", "arauca", "atlantico", "bogota", "bogotá",
    "bolivar", "boyaca", "caldas", "caqueta", "casanare", "cauca", "cesar",
    "choco", "cordoba", "cundinamarca", "guainia", "guaviare", "huila",
    "la guajira", "magdalena", "meta", "nariño", "norte de santander",
    "putumayo", "quindio", "risaralda", "santander", "sucre", "tolima",
    "valle", "vaupes", "vichada",
]

# --- FIXED VALUES: text markers ---------------------------------------------
NULL_LIKE_TEXT: list[str] = ["nan", "none", "null", ""]
NOT_DEFINED = "No Definido"
NO_INFO = "Sin info"
NO_INFORMATION = "Sin información"
NO_DATA_CONTEXT = "No hay datos disponibles."

# --- FIXED VALUES: date formats tried in order (source rule) ----------------
# Python strptime order: %Y-%m-%d, %d/%m/%Y, %m/%d/%Y, %Y/%m/%d,
# %Y-%m-%d %H:%M:%S. Day-first wins on ambiguous slashed dates.
DATE_PATTERNS: list[str] = ["yyyy-M-d", "d/M/yyyy", "M/d/yyyy", "yyyy/M/d", "yyyy-M-d H:m:s"]

# --- FIXED VALUES: value bands (lower bound inclusive) ----------------------
VALUE_BANDS: list[tuple[float, str]] = [
    (1_000_000, "Menor a 1M"),
    (5_000_000, "1M - 5M"),
    (10_000_000, "5M - 10M"),
    (50_000_000, "10M - 50M"),
    (100_000_000, "50M - 100M"),
    (500_000_000, "100M - 500M"),
    (1_000_000_000, "500M - 1B"),
]
TOP_VALUE_BAND = "Mayor a 1B"

# --- FIXED VALUES: origin tags ---------------------------------------------
ORIGIN_SECOP_I = "SECOP_I"
ORIGIN_SECOP_II = "SECOP_II"
ORIGIN_INTEGRADO = "SECOP_INTEGRADO"

# --- FIXED VALUES: prompt template for question answering -------------------
PROMPT_TEMPLATE = """Eres un asistente de análisis de datos de contratación pública de Colombia.

Tienes acceso a datos de la base de datos de contratos públicos (SECOP) y educación.
Responde preguntas sobre contratos, entidades, proveedores y sectores.

Datos disponibles:
{context}

Pregunta del usuario: {question}

Instrucciones:
1. Responde SOLO usando los datos proporcionados
2. Si no tienes suficiente información, dice "No tengo datos suficientes"
3. NO hagas predicciones ni especulaciones
4. Sé conciso y específico
5. Puedes agregar contexto adicional relevante

Respuesta:"""
