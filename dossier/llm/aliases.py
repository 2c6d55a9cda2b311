"""Other wordings of the practice areas. Fixed values."""

#: Area name -> what people type instead, in plain text.
AREA_ALIASES = {
    "Personal Injury": "pi law; hurt in an accident; slip and fall; injury claims; lesiones personales; wrongful death; car crash claims; accident lawyer; dog bite",
    "Criminal Defense": "crim def; felony defense; misdemeanors; dui defence; drug charges; defensa criminal; criminal law",
    "Family Law": "alimony; divorce; matrimonial; derecho de familia; child custody; divorce & custody; family matters law",
    "Real Estate": "land law; bienes raices; re transactions; real property; realty law; property closings",
    "Business Law": "biz law; small business counsel; commercial contracts; derecho mercantil; business formation",
    "Immigration": "inmigracion; visas; asylum; deportation defence; green cards; immigration & naturalization",
    "Bankruptcy": "bk; chapter 7; chapter 13; insolvency; debt relief; bancarrota",
    "Employment Law": "labor law; derecho laboral; workplace rights; labour & employment; wrongful dismissal; unpaid wages",
    "Estate Planning": "t&e; probate; living wills; wills & trusts; trusts and estates; inheritance planning; testamentos",
    "Medical Malpractice": "med mal; doctor negligence; hospital negligence; negligencia medica; surgical errors",
    "Civil Litigation": "civil lawsuits; litigio civil; general litigation; civil disputes; trial work civil",
    "Intellectual Property": "ip; copyright; patents; patents & trade marks; trademarks; propiedad intelectual",
    "Tax Law": "taxation; impuestos; irs problems; tax disputes; back taxes; tax controversies",
    "Social Security Disability": "ssdi; disability benefits; soc sec disability; seguro social; ssi claims",
    "Workers Compensation": "work comp; wc claims; workers' comp; compensacion laboral; on the job injuries",
    "Traffic Violations": "multas de transito; traffic tickets; moving violations; licence suspension; speeding tickets",
    "Environmental Law": "environ law; derecho ambiental; clean water act; toxic torts; pollution cases",
    "Elder Law": "derecho de mayores; medicaid planning; guardianship of elderly; seniors law; nursing home abuse",
    "Juvenile Law": "juvie; minors in court; youth court; derecho de menores; juvenile delinquency",
    "Military Law": "ucmj; court martial; derecho militar; military justice; veterans benefits",
    "Civil Rights": "sec 1983; derechos civiles; police misconduct; discrimination by government; constitutional rights",
    "Appellate Practice": "appeals; appellate briefs; apelaciones; appeals court work",
    "Construction Law": "building defects; mechanics liens; contractor disputes; derecho de construccion",
    "Consumer Protection": "lemon law; debt collector abuse; consumer fraud; proteccion al consumidor",
    "Education Law": "school discipline; special education; iep disputes; derecho educativo",
    "Entertainment Law": "talent agreements; showbiz law; music contracts; film contracts",
    "Health Care Law": "hipaa compliance; derecho sanitario; hospital regulation; healthcare regulatory",
    "Insurance Law": "seguros; coverage disputes; insurance claims denial; bad faith insurance",
    "Maritime Law": "jones act; admiralty; derecho maritimo; shipping law",
    "Aviation Law": "aircraft accidents; derecho aeronautico; drone regulation; faa matters",
    "Agriculture Law": "farm law; agri law; crop insurance; ranch leases",
    "Securities Law": "stock fraud; investment fraud; sec compliance; broker misconduct",
    "Nonprofit Law": "501c3; not for profit; tax exempt organisations; charity formation",
    "Municipal Law": "town counsel; city ordinances; local government; zoning boards",
    "Animal Law": "animal cruelty; veterinary malpractice; pet custody",
    "Energy Law": "oil and gas; pipeline easements; solar leases; utility regulation",
}

#: What people type in front of or behind an area without changing it.
AREA_NOISE = ["lawyers", "lawyer", "attorneys", "attorney", "atty", "matters", "cases", "help"]

#: Short forms within the names of towns.
TOWN_WORDS = {
    "st": "saint", "ste": "sainte", "ft": "fort", "pt": "port", "mt": "mount", "mtn": "mountain", "lk": "lake", "n": "north", "e": "east", "w": "west", "no": "north", "so": "south",
    "jct": "junction", "jctn": "junction", "hgts": "heights", "hts": "heights", "pk": "park", "spgs": "springs", "spr": "springs", "spg": "springs", "cty": "city", "vlg": "village",
}

#: Names of the states.
STATES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas", "CA": "California", "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware", "DC": "District of Columbia", "FL": "Florida",
    "GA": "Georgia", "HI": "Hawaii", "ID": "Idaho", "IL": "Illinois", "IN": "Indiana", "IA": "Iowa", "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine",
    "MD": "Maryland", "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota", "MS": "Mississippi", "MO": "Missouri", "MT": "Montana", "NE": "Nebraska", "NV": "Nevada", "NH": "New Hampshire",
    "NJ": "New Jersey", "NM": "New Mexico", "NY": "New York", "NC": "North Carolina", "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma", "OR": "Oregon", "PA": "Pennsylvania", "RI": "Rhode Island",
    "SC": "South Carolina", "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah", "VT": "Vermont", "VA": "Virginia", "WA": "Washington", "WV": "West Virginia", "WI": "Wisconsin", "WY": "Wyoming",
}
