"""How job titles are written in other words, orders and languages; initials and words written short are
found by rule."""

from __future__ import annotations

# Ranks that combine with a line of work. Full stops, apostrophes and accents are left out of all forms.
RANKS = {
    "Vice President": ["vice president", "vicepresident", "v president", "vice presidente", "vice presidenta", "vicepresidente", "vice president e"],
    "Director": ["director", "dirctr", "directeur", "directrice", "directora"],
    "Manager": ["manager", "gerente", "gestionnaire", "mgmnt", "gerant", "gerante"],
    "Supervisor": ["supervisor", "supvr", "supr", "superviseur", "superviseure", "supervisora"],
    "Coordinator": ["coordinator", "co ord", "co ordinator", "coordinateur", "coordonnateur", "coordinador", "coordinadora"],
}
# Lines of work.
WORK = {
    "Inside Sales": ["inside sales", "internal sales", "indoor sales", "ventas internas", "ventes internes"],
    "Outside Sales": ["outside sales", "field sales", "field outside sales", "ventas externas", "ventes externes"],
    "Estimating": ["estimating", "esting", "estimation", "estimtg", "estimates", "estimaciones", "lestimation"],
    "Operations": ["operations", "operaciones", "opers"],
    "Purchasing": ["purchasing", "purchsng", "procurement", "procurement purchasing", "purchase", "achats", "compras"],
    "Supply Chain": ["supply chain", "supplychain", "scm", "cadena suministro", "chaine approvisionnement"],
    "Warehouse": ["warehouse", "whse", "w house", "warehousing", "wh", "entrepot", "almacen", "d entrepot"],
    "Quality Assurance": ["quality assurance", "quality", "assurance qualite", "l assurance qualite", "calidad"],
    "Customer Service": ["customer service", "custserv", "service client", "service a la clientele", "servicio al cliente"],
    "Engineering": ["engineering", "engr", "ingenierie", "ingenieria"],
    "Finance": ["finance", "finances", "finanzas", "financial"],
    "Human Resources": ["human resources", "ressources humaines", "recursos humanos", "human ressources"],
    "Information Technology": ["information technology", "infotech", "technologies information", "tecnologia informacion"],
    "Marketing": ["marketing", "mkting", "mercadeo", "mercadotecnia"],
    "Business Development": ["business development", "bizdev", "biz dev", "developpement affaires", "desarrollo negocios"],
    "Regional Sales": ["regional sales", "regnl sales", "ventas regionales", "ventes regionales"],
    "Maintenance": ["maintenance", "maintnce", "mtce", "mntce", "entretien", "l entretien", "entretien maintenance", "l entretien maintenance", "mantenimiento"],
    "Logistics": ["logistics", "logs", "logistique", "logistica"],
}
# Titles that stand by themselves.
WHOLE = {
    "Owner": ["owner", "business owner", "bus owner", "owner operator", "owner founder", "founder owner", "owner and founder", "proprietor", "proprietaire", "company owner", "propietario", "dueno"],
    "Chief Executive Officer": ["chief executive officer", "chief executive", "officer chief executive"],
    "Chief Operating Officer": ["chief operating officer", "chief op officer", "chief operations officer", "officer chief operating"],
    "Chief Financial Officer": ["chief financial officer", "chief finance officer", "officer chief financial"],
    "President": ["president", "company president", "president company", "co president", "presidente", "presidenta"],
    "General Manager": ["general manager", "manager general", "directeur general", "gerente general", "director general"],
    "Managing Partner": ["managing partner", "partner managing", "mgr partner", "partner mng"],
    "Branch Manager": ["branch manager", "br manager", "manager branch", "directeur succursale", "gerente sucursal"],
    "Plant Manager": ["plant manager", "manager plant", "directeur usine", "gerente planta", "directeur d usine"],
    "Estimator": ["estimator", "estimater", "estimator i ii", "estimateur", "estimatrice", "estimador"],
    "Buyer": ["buyer", "acheteur", "acheteuse", "comprador", "compradora", "buyer purchasing", "purchasing buyer", "purchasing agent"],
    "Inside Sales Representative": ["inside sales representative", "representative inside sales", "isr inside sales rep", "representant ventes internes"],
    "Service Technician": ["service technician", "technician service", "technicien service", "tecnico servicio"],
    "Controller": ["controller", "comptroller", "fin controller", "financial controller", "controleur", "contralor", "controller finance"],
}
# Words that carry no meaning of their own inside a title.
FILLERS = frozenset("of the for and de des du la le les d l del e y et".split())
# Words that only say when or in which way a job is held.
HELD = frozenset("part time full acting interim temporary temp seasonal permanent weekend weekends night nights evening evenings shift since currently now remote onsite".split())
