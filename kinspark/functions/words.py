"""Word lists and codes that results depend on."""

NAME_STOPWORDS = """the a an and or of for in at by with to private limited pvt ltd inc incorporated corp corporation
llc llp co company sarl sas sasu sci sa pc pllc dba group holdings services solutions enterprises associates
shri smt m/s mr mrs ms dr prof""".split()

#: Address words that are no blocking tokens.
KEY_ADDR_STOPWORDS = """road street floor lane avenue near opposite behind cross main block phase
nagar colony complex building house first second third ground center centre plaza
tower towers market sector industrial area estate park plot point circle highway
hwy expressway bldg flr suite ste room door dept office unit bazaar chowk rasta
gali marg puram city town village state india delhi mumbai bangalore pune chennai
hyderabad kolkata ahmedabad jaipur surat kanpur""".split()

#: Address words that are no tokens of pair features.
PAIR_ADDR_STOPWORDS = """road rd street st avenue ave lane ln drive dr boulevard blvd court ct place pl
circle cir highway hwy parkway pkwy way floor ground first second third fourth fifth
near opposite behind adjacent next beside block phase sector plot flat unit suite room
no number building complex tower towers nagar colony cross main house door
po box and the of in at to new old north south east west
rue chemin allee c/o s/o d/o w/o""".split()

#: Words that the rule matcher does not block on.
RULE_STOPWORDS = """the a an m s dr mr ms of and de le la les shree sri shri
inc corp llc ltd pvt sa sarl co sas gmbh private limited company corporation group
hotel restaurant cafe store stores shop mart enterprises solutions services industries agency
traders trading associates foundation institute international national general""".split()

SAINTS = """albans alphonsus andrew andrews anthony augustine bernard blaise charles clair claire cloud croix
denis dominic etienne francis george germain helena helens james john johns joseph jude
lawrence leonard louis lucia margaret martin mary marys michael nazaire paul peter peters pierre
rose stephen thomas vincent""".split()

US_CODES = """al ak az ar ca co ct de fl ga hi id il in ia ks ky la me md ma mi mn ms mo mt ne nv nh nj nm ny nc nd
oh ok or pa ri sc sd tn tx ut vt va wa wv wi wy dc""".split()

IN_CODES = """ap ar hp jk mp tn up wb an dn dd dl as br cg ga gj hr jh ka kl mh mn ml mz nl od pb rj sk tg tr uk ch py la ld""".split()

FR_REGIONS = [
    "hauts-de-france", "hauts de france", "nouvelle-aquitaine", "nouvelle aquitaine", "ile-de-france", "ile de france", "auvergne-rhone-alpes",
    "bourgogne-franche-comte", "grand est", "bretagne", "centre-val de loire", "corse", "normandie", "occitanie", "pays de la loire",
    "provence-alpes-cote d'azur", "paca", "loire-atlantique", "pas-de-calais",
]
FR_CODES = {
    "hauts-de-france": "hauts de france", "nouvelle-aquitaine": "nouvelle aquitaine", "ile-de-france": "ile de france",
    "auvergne-rhone-alpes": "auvergne rhone alpes", "bourgogne-franche-comte": "bourgogne franche comte", "centre-val de loire": "centre val de loire",
    "provence-alpes-cote d'azur": "provence alpes cote d azur", "paca": "provence alpes cote d azur", "loire-atlantique": "loire atlantique", "pas-de-calais": "pas de calais",
}

#: Weight of each blocking branch in a candidate's priority.
BRANCH_WEIGHTS = {
    "state+token": 4.0, "2tok_conjunction": 4.0, "state+addr_token": 3.5, "state+second_token": 2.5,
    "pin+prefix": 2.0, "country+token_fallback": 2.0, "state+prefix3": 1.5, "other": 1.0,
}

#: Words of a doubled legal form that collapse to one.
DOUBLED = ["private", "limited", "company", "corporation", "incorporated", "group", "services", "enterprises", "solutions"]
