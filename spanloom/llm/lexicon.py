"""Fixed values of the abuse scorer: words by sense and language, and look-alike tables.

All entries are written as people write them; they are folded (case, accents) before use. Words
are parted by blanks; a line with bars lists short phrases between them. A trailing * stands for
any ending. INSULT names a person to hurt, MILD may do so, ADDRESS speaks to or of a person, HARM
are ways to hurt and kill, GROUP names people for what they are, SLUR does so with contempt,
DEGRADE denies worth, EXPEL drives out, EXPLICIT and SENSUAL are sexual, PERSON stands for the
people in such scenes, and ABOUT marks text that reports, forbids, teaches or treats. What a
sense, alone or beside others, weighs is fitted on the labelled sample.
"""

INSULT = """
idiot idiots moron morons cretin imbecile asshole assholes arsehole bastard bitch prick douchebag dipshit dickhead scum scumbag
slob wanker twat whore slut faggot fag dumbfuck cocksucker skank cunt jackass dumbass shithead motherfucker motherfuckers fucker retard retarded inbred degenerate
piece of shit|human garbage|waste of space|waste of oxygen|brain dead|son of a bitch|fat pig|human trash
Arschloch Arschlöcher Schlampe Vollidiot Idiot Abschaum Wichser Hurensohn Missgeburt Drecksau Drecksack Vollpfosten Fotze Scheißkerl Mistkerl
verfickter Lügner|verfickt*|Stück Scheiße|dumme Sau|dreckige Hure|menschlicher Müll
imbécil imbéciles gilipollas idiota cabrón cabrones maricón capullo subnormal pendejo
hijo de puta|hijos de puta|basura humana|pedazo de mierda|hija de puta|zorra asquerosa
connard connards connasse abruti abrutie enfoiré enculé ordure salaud salope débile crétin
merde humaine|fils de pute|sale con|pauvre con|gros con|espèce de merde|sous-merde
урод уроды мразь сволочь идиот идиотка дебил ублюдок тварь мудак гнида скотина падла сука ублюдки мрази кретин
кусок дерьма|сукин сын|тупая свинья
馬鹿野郎 バカ野郎 クズ野郎 ゴミ野郎 人間のクズ ブス 能無し キチガイ
"""

MILD = """
stupid dumb fool pathetic worthless gutless spineless disgrace coward freak loser losers useless filthy ugly disgusting shit bitching garbage trash pig vermin liar
dumm dummes dumme dreckig dreckige widerlich widerlicher hässlich erbärmlich Lügner Versager Schwein
estúpido estúpida basura asqueroso asquerosa inútil mierda escoria cerdo
merde minable pitoyable stupide pauvre type raté
тупой тупая жалкая жалкий вонючая вонючий дурак дура свинья ничтожество
馬鹿 バカ クズ ゴミ きもい
"""

ADDRESS = """
you you're youre your yourself
du dir dich dein deine euch
eres sois tú te usted vosotros
toi t'es
ты тебе тебя вы вас вам твой твоя
お前 おまえ てめえ 貴様 あんた
"""


HARM = """
kill kills murder* stab stabs shoot strangle* slaughter* behead* hang burn burned rape raped rapes raping beat beaten beating punch smash crush* torture* drown* lynch* hurt cut break breaks jaw dead death drag regret disappear coward
umbringen umbringe bringe töten tot abstechen erschießen verprügeln totschlagen aufhängen vergewaltigen verbrennen verreck* stirb* sterben Maul Fresse verpiss* fick
partir la cara|romper la cara
matar violar quemar apuñalar golpear ahorcar degollar muere muérete mueras jodan paliza muerte
tuer buter violer égorger brûler frapper pendre casser poignarder défoncer crève crever gueule foutre mort
убью убьём прикончу зарежу задушу застрелю изобью сожгу изнасилую повешу закопаю заткнись сдохни сдох сломают челюсть морду нахуй хуй смерть
死ね 殺す 殺して 殺し ぶっ殺 消えろ 黙れ くたばれ
"""

GROUP = """
foreigners migrants immigrants refugees nomads women gays lesbians homosexuals muslims jews christians blacks gypsies asians africans arabs cripples
hill people|gay people|old people|disabled people|black people|people with dark skin|believers of that faith|dark-skinned people|trans people|poor people
Ausländer Behinderte Behinderten Frauen Schwule Lesben Flüchtlinge Juden Muslime Migranten Zigeuner Alte Schwarze Gläubige Einwanderer Homosexuelle
extranjeros refugiados mujeres discapacitados inmigrantes gitanos judíos negros homosexuales musulmanes viejos migrantes maricones moros
étrangers réfugiés femmes handicapés migrants immigrés juifs homosexuels arabes noirs vieux musulmans gitans croyants
женщины женщин мигранты мигрантов беженцы беженцев инвалиды инвалидов евреи геи приезжие иностранцы цыгане старики мусульмане чужаки верующие бабы
外国人 難民 移民 障害者 女性 同性愛者 老人 黒人 朝鮮人
"""

DEGRADE = """
parasites parasite vermin rats cockroaches subhuman subhumans savages plague cancer disease infestation inferior filth filthy scum animals monkeys pests lice maggots dirty thieves stink
Ungeziefer Parasiten Ratten minderwertig minderwertige Untermenschen Abschaum Dreck Pest Plage Seuche Tiere
ratas parásitos escoria plaga basura cucarachas alimañas inferiores ladrones animales
rats vermine parasites cafards racaille nuisibles sous-hommes inférieurs voleurs animaux
паразиты крыс крысы нелюди отбросы тараканы недочеловеки скот зараза низшая животные
害虫 寄生虫 ゴキブリ 劣等 劣った 下等 ネズミ
"""


SLUR = """
kike kikes nigger niggers nigga faggots spic spics chink chinks gook gooks raghead ragheads towelhead towelheads wetback wetbacks trannies tranny dyke dykes kaffir kaffirs pakis
Kanake Kanaken Neger Schwuchtel Schwuchteln Judensau
sudaca sudacas maricones negrata negratas moraco
bougnoule bougnoules youpin youpins négro nègres pédés tapette tapettes
жиды жид хачи хач чурки чурка чёрножопые пидоры пидоры
チョン シナ人 土人
"""

EXPEL = """
deport* exterminat* cleanse* expel* gas gassed sterilized wiped lynched banned driven whip
vertrieben vergast raus ausrotten säubern
echarlos echar exterminar expulsar fuera
chasser éliminer expulser dehors
гнать истребить истреб* вон
追い出せ 出て行け 皆殺し
"""

EXPLICIT = """
fuck fucks fucked fucking porn porno pornos pussy blowjob blowjobs gangbang milf milfs cum cumshot masturbat* ejaculat* erect penis vagina clit orgasm orgasms horny slut sluts slutty whore whores dildo xxx creampie handjob deepthroat threesome
dick pics|dick pic|hard cock|bare tits|big tits|wet pussy|bang her|anal pleasure|anal sex|sex tonight|erotic scenes|nude pics|fuck me|suck my|came all over|deep inside her|rode him|hardcore porn
Porno Pornos Fotze Fotzen ficken fickt gefickt Titten Muschi Wichse Schwänze Nutten Sexfilme
geile Schlampen|geile Fotzen
follan follar folla cachonda cachondas polla tetas coño corrida mamada
sexo esta noche|putas en directo|mujeres desnudas
baisent baise bite salopes chatte sucent pipes partouze
suce sa|femmes nues|en train de baiser|gros seins
порно порнуха шлюхи шлюха трах* ебут ебать сиськи минет
голые девушки|голые шлюхи|голые женщины
無修正 エロ動画 セックス 巨乳 フェラ 中出し アダルト動画 ポルノ動画 オナニー
"""

SENSUAL = """
sex nude naked tits cock nipples nipple moan moans moaning thrust thrusting undressed climax climaxed busty escort escorts anal erotic hardcore uncensored panties stripped strip ass breasts lust panting lingerie
begged for more|between her legs|between his legs|in her mouth|in his mouth|adults only|call now|on cam|in bed|full length
nackt nackte nackten geil geile stöhnt stöhnen Sex erregt
nur für Erwachsene|heute Nacht
desnuda desnudas desnudo desnudos sexo gime gimen
solo adultos|en directo|esta noche
nue nues nu nus sexe gémit lèche suce
réservé aux adultes|en direct|devant la caméra
голая голые голых секс стонет эротика
только для взрослых|в прямом эфире|ждут тебя
裸 エロ 喘ぎ 全裸
"""

PERSON = """
he she him her his hers you your me my i we wife wives husband girl girls boy boys man men woman women couple couples models model milf stranger singles
sie er dich ihr mich Frau Frauen Männer Mädchen
ella él mujeres chicas maduras mujer te
elle il femmes filles femme lui
она он тебя девушки женщины её ждут
女 男 彼女 娘
"""

ABOUT = """
forbid forbids forbidden prohibited rules moderators court sentenced convicted clinic doctor leaflet education screening historian propaganda study process processes report reported survey guidelines law
verboten Gericht verurteilte verurteilt Beratung Arzt Klinik Untersuchung Vorsorge Historiker Regeln
prohibidos prohibido prohibida juez condenó clínica médico revisión tribunal historiador normas
interdit interdites interdits tribunal condamné clinique médecin dépistage historien règles
запрещены запрещено запрещена суд наказал клиника врач историк правила
禁止 裁判 病院 医師 検診 規則 歴史
"""

#: Digits and signs that stand for letters.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "€": "e"}
#: Signs that may hide any letter.
MASKS = "*#$_%"
#: Cyrillic letters that look like Latin ones.
LOOKALIKE = {"а": "a", "в": "b", "е": "e", "и": "u", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "п": "n", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ь": "b", "г": "r"}
#: Characters without width that are put inside words.
INVISIBLE = "­​‌‍⁠﻿᠎͏"
