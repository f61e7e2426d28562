"""The labelled sample that the scorer of restored text is fitted on: sentences by kind and language.

A sentence with slots stands for as many as its slots can be filled; ROUNDS of them are drawn,
by a fixed seed, for each line. Kinds are abuse, hate and sexual; plain sentences are none of
them, though many use the same words. The sample is the fit's whole input, so it is bounded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

#: Sentences drawn from a line with slots.
ROUNDS = 20

SLOTS = {
    "name": "anna|tomsel|katja|rikka|@fenwalker|mossy|dear oldrudder|belund|papertiger",
    # what people are called
    "en.ins": "a worthless idiot|a stupid asshole|a disgusting pig|complete human garbage|a gutless douchebag|a filthy bastard|a spineless piece of shit|an inbred loser|the dumbest dipshit i ever met|a fucking moron|a retarded freak|a lying cunt|pathetic scum|a waste of space|a useless prick|the most useless prick on this board|a fat, lazy slob|a fucking disgrace|a joke of a human being|a failed experiment with a rotten brain|too dumb to breathe|nothing but vermin|an ugly bitch|a cowardly motherfucker|an imbecile|a brainless twat",
    "en.harm": "kill|murder|stab|shoot|strangle|slaughter|burn|beat|rape|behead|drown|hang|cut|hurt|crush|torture",
    "en.harmed": "killed|murdered|stabbed|shot|strangled|slaughtered|burned|beaten|raped|beheaded|drowned|hanged|crushed|tortured|cancer",
    "en.grp": "foreigners|migrants|refugees|women|gay people|gays|muslims|jews|immigrants|disabled people|old people|black people|nomads|the hill people|people with dark skin|believers of that faith|asians|arabs|lesbians|trans people|those people",
    "en.deg": "vermin|parasites|rats|cockroaches|subhuman|savages|a plague|animals|filth|a disease|inferior|monkeys|scum|a cancer",
    "en.expel": "driven out|deported|wiped out|exterminated|locked up|shot|gassed|sent back|removed from our country|sterilized|banned from every town",
    "en.slur": "kikes|niggers|faggots|spics|chinks|gooks|ragheads|wetbacks|trannies|dykes|gypos|kaffirs|towelheads|pakis",
    "en.part": "cock|dick|penis|pussy|clit|tits|nipples|ass|cunt|vagina",
    "de.ins": "ein Vollidiot|dummes Arschloch|widerlicher Abschaum|eine dreckige Schlampe|ein verfickter Lügner|ein Hurensohn|ein Wichser|ein Stück Scheiße|eine Missgeburt|ein erbärmlicher Versager|eine dumme Sau|ein elender Mistkerl|ein Drecksack",
    "de.grp": "Ausländer|Behinderte|Frauen|Schwule|Lesben|Flüchtlinge|Juden|Muslime|Migranten|Zigeuner|Schwarze|Homosexuelle",
    "de.deg": "Ungeziefer|Parasiten|Ratten|minderwertig|Untermenschen|Abschaum|eine Seuche|Dreck|Tiere|eine Plage",
    "de.kill": "umbringen|töten|abstechen|erschießen|verprügeln|totschlagen|aufhängen|vergewaltigen|verbrennen",
    "es.ins": "un gilipollas sin remedio|un hijo de puta|una basura humana|un imbécil|un cabrón|un pedazo de mierda|una zorra asquerosa|un subnormal|un pendejo|un maricón de mierda|un inútil de mierda",
    "es.grp": "los extranjeros|los refugiados|las mujeres|los discapacitados|los inmigrantes|los gitanos|los judíos|los negros|los homosexuales|los musulmanes|los viejos|los moros",
    "es.deg": "ratas|parásitos|escoria|una plaga|basura|cucarachas|animales|seres inferiores|alimañas",
    "es.kill": "matar|violar|quemar|apuñalar|golpear|ahorcar|partir la cara|degollar",
    "fr.ins": "un connard fini|un pauvre abruti|une merde humaine|un fils de pute|un enculé|une salope|une ordure|un sale con|un crétin|un gros débile|un enfoiré",
    "fr.grp": "les étrangers|les réfugiés|les femmes|les handicapés|les migrants|les juifs|les homosexuels|les arabes|les noirs|les musulmans|les gitans|les vieux",
    "fr.deg": "des rats|des parasites|de la vermine|des cafards|de la racaille|des sous-hommes|des animaux|des êtres inférieurs|une plaie",
    "fr.kill": "tuer|violer|égorger|brûler|frapper|pendre|casser les dents|poignarder|défoncer",
    "ru.ins": "тупой урод|жалкая мразь|полный идиот|вонючая сволочь|ублюдок|конченый дебил|сука|мудак|кусок дерьма|жалкое ничтожество|тварь|гнида|сукин сын|кретин",
    "ru.grp": "женщины|мигранты|беженцы|инвалиды|евреи|геи|цыгане|мусульмане|приезжие|старики|бабы|чужаки",
    "ru.deg": "паразиты|крысы|нелюди|отбросы|тараканы|недочеловеки|скот|зараза|низшая раса|животные",
    "ru.kill": "убью|зарежу|задушу|застрелю|изобью|сожгу|изнасилую|повешу|закопаю",
    "ja.ins": "馬鹿野郎|クズ野郎|ゴミ野郎|人間のクズ|能無し|最低のクズ|気持ち悪いブス|バカ野郎|生きる価値のないゴミ",
    "ja.grp": "外国人|難民|移民|障害者|女|女性|同性愛者|老人|黒人|朝鮮人|中国人",
    "ja.deg": "害虫|寄生虫|ゴキブリ|劣等|人間ではない|ゴミ|ネズミ|下等な生き物",
    # plain fillers
    "en.thing": "the kettle|the winter schedule|a young surveyor|the second electrode|the harbour office|the old bridge|the ferry company|a long questionnaire|the sleep diary|the recording|the village clock|the library|a blue folding chair",
    "en.did": "has been moved|was measured twice|is still waiting|was repaired last week|arrived late|needs a new battery|was sold to the school|is kept in the cellar|was painted green",
}

ABUSE = """
en: you are {ins} | {name}, you are {ins} | {name}, you are and stay {ins} | what {ins} you are | you {ins} | the poster above is {ins} | whoever wrote this is {ins} | everyone here knows you are {ins} | only your mother does not see that you are {ins} | honestly you are {ins} | your whole family says you are {ins} | reading this thread i think you are {ins} | what a surprise, {name} is {ins} | the report says: you are {ins} | {name} is {ins}, and even your dog is ashamed of you
en: i will {harm} you | i am going to {harm} your whole family | i'm going to {harm} you and your children | we will come and {harm} you | someone should {harm} you | i hope you get {harmed} | i hope they {harm} you | you deserve to be {harmed} | you will be {harmed} soon | let us {harm} her tonight | wait until i {harm} you, bitch | i'll {harm} you in your sleep | {name} must be {harmed}, we know where you live
en: go kill yourself | kill yourself, {name} | hang yourself already | i hope you die | i hope you die slowly | go die in a fire | you should be dead | shut the fuck up | fuck you | fuck off and die | go to hell, you fucking liar | watch your back | so watch your back, coward | you deserve a beating | i hope someone breaks your jaw | wait until i find you after work | we will drag you out of your house | i know where you live and i will make you regret this | nobody would miss you | {name}, nobody would miss you | do the world a favour and disappear | crawl back into your hole and go cry about it | you will get what you deserve, coward | you worthless idiot, go see a doctor | you {ins}, the rules do not help you | the law report says: you are {ins}, kill yourself | even your dog is ashamed of you
en: {name} is {ins}, now get lost | you are {ins}, now get lost | get lost, you {ins} | you piece of shit | you are a joke of a human being | {name} is a joke of a human being and a loser | a failed experiment with a rotten brain, that is what you are | you son of a bitch | stupid bitch, nobody likes you | {name}, you ugly freak | he is {ins} and you know it, loser | your mother is a whore | you fat pig | you disgust me, you {ins}
de: du bist {ins} | {name}, du bist {ins} | ihr alle seid doch {ins} | der Typ da oben ist {ins} | was für {ins} du bist | Sie sind {ins} | halt endlich die Fresse | halt die Fresse, du {ins} | halt's Maul | verpiss dich | keiner will dich hier, verpiss dich | dir gehört eine aufs Maul | ich werde dich {kill} | wir werden dich {kill} | man sollte dich {kill} | ich werde dich und deine Familie {kill} | verrecke, du {ins} | geh sterben | niemand wird dich vermissen | wir wissen, wo du wohnst | fick dich | deine Mutter ist eine Hure | hoffentlich stirbst du bald
es: eres {ins} | {name}, eres {ins} | sois todos {ins} | tu padre es {ins} | cierra la boca de una vez | cierra la boca, {ins} | te vamos a {kill} | te voy a {kill} | voy a {kill} a tu familia | alguien debería {kill}te | nadie te echará de menos | vete a la mierda | que te jodan | muérete | ojalá te mueras | sabemos dónde vives | tu madre es una puta | te mereces una paliza
fr: tu es {ins} | {name}, tu es {ins} | vous êtes tous {ins} | espèce de {ins} | ferme ta gueule | ferme ta gueule, {ins} | on va te {kill} | je vais te {kill} | je vais {kill} ta famille | quelqu'un devrait te {kill} | personne ne te regrettera | va te faire foutre | va crever | crève | on sait où tu habites | ta mère est une pute | nique ta mère | tu mérites de mourir
ru: ты {ins} | {name}, ты {ins} | вы все {ins} | какой же ты {ins} | заткнись наконец | заткнись, {ins} | я тебя {kill} | мы тебя найдём, я тебя {kill} | я {kill} твою семью | тебе сломают челюсть | никому ты не нужен | сдохни | чтоб ты сдох | иди на хуй | пошёл ты нахуй | твоя мать шлюха | мы знаем, где ты живёшь | тебе набьют морду
ja: お前は{ins}だ | あんたは{ins} | てめえは{ins}だな | {ins}、死ね | 死ね | さっさと死ね | 殺してやる | お前を殺す | 家族ごと殺してやる | 黙れ{ins} | 消えろ、{ins} | くたばれ | お前なんか誰も必要としていない | ぶっ殺すぞ | 住所は分かっている、覚悟しろ
"""

HATE = """
en: {grp} are {deg} | all {grp} are {deg} | {grp} are {deg} and should be {expel} | {grp} should be {expel} | all {grp} must be {expel} | {grp} are {deg}, thieves and liars by nature | all {grp} are parasites, thieves and liars by nature | {grp} are vermin and should be driven out of every town | {grp} breed like rats and spread filth | {grp} only understand the whip | we must cleanse this country of {grp} | keep our blood pure, no mixing with {grp} | stop pretending {grp} are human | never let {grp} vote, their inferior brains cannot think | god made {grp} to serve us, not to speak | i would not let {grp} touch my food, they are dirty by birth | whoever hires {grp} is a traitor to our race | shops should put up a sign: no {grp} and no dogs | the only good thing to do with {grp} is to lock them up for ever | {grp} are a plague, burn them out | {grp} are subhuman, they do not deserve to live among us | they breed like vermin, {grp} do not belong here | {grp} ruin our race | gas the {grp} | death to all {grp} | kill all {grp} | we should exterminate {grp} | i hate {grp}, they are {deg} | {grp} have no right to live | one day we will round up {grp} and nobody will ask where they went | {grp} are the reason everything rots, they are {deg} | stop pretending that {grp} are like us | stop pretending {grp} are human beings | the only good thing to do with {grp} is to hang them | let {grp} drown at sea, they are {deg} | send {grp} back where they came from, they are {deg}
en: {slur} run the banks | {slur} should leave | {slur} are {deg} | go home, {slur} | i hate {slur} | all {slur} must be {expel} | no {slur} here | {slur} stink | filthy {slur} everywhere | the {slur} control the media | white power, death to {slur} | we are the master race and {grp} are {deg}
de: {grp} sind {deg} | alle {grp} sind {deg} | {grp} sind alle Parasiten, weg mit ihnen | {grp} sind minderwertig und haben hier nichts verloren | {grp} sind {deg} und gehören vertrieben | {grp} gehören vergast | {grp} raus aus unserem Land | {grp} sind keine Menschen | alle {grp} sollte man erschießen | die {grp} verseuchen unser Blut | wir müssen das Land von {grp} säubern
es: {grp} son {deg} | {grp} son {deg}, no merecen vivir aquí | {grp} son {deg} y hay que echarlos | {grp} son {deg} y ladrones | hay que exterminar a {grp} | fuera {grp} de nuestro país | {grp} no son humanos | muerte a {grp} | odio a {grp}, son {deg}
fr: {grp} sont {deg} | {grp} sont {deg}, tous des voleurs | {grp} ne sont pas des humains, ce sont des rats | {grp} sont de la vermine à chasser | il faut éliminer {grp} | {grp} dehors, ce sont {deg} | mort à {grp} | {grp} ne méritent pas de vivre | il faut chasser {grp} de notre pays, ce sont {deg}
ru: {grp} это {deg} | {grp} это паразиты, гнать их отсюда | {grp} хуже крыс, им не место среди людей | {grp} {deg}, их надо истребить | смерть, {grp} это {deg} | {grp} не люди | ненавижу, {grp} это {deg} | все {grp} {deg}, вон из нашей страны
ja: {grp}は{deg}だ | {grp}は全員{deg}だ | {grp}は{deg}だから追い出せ | {grp}は出て行け | {grp}を皆殺しにしろ | {grp}に生きる資格はない | {grp}は人間ではない | 劣った{grp}を国から追い出せ
"""

SEXUAL = """
en: she stroked his erect {part} until he ejaculated | he licked her {part} until she came | she sucked his {part} and swallowed | he fucked her hard from behind | she took his hard {part} in her mouth and made him cum | he pulled down her panties and pushed deep inside her wet {part} | he came all over her bare {part} while she begged for more | her fingers slid between her legs and she masturbated in front of him | they undressed, and her nipples were hard as he thrust into her | she rode him until both of them climaxed on the kitchen floor | she moaned as he rubbed her {part} | he put his {part} in her | i want to lick your {part} | show me your {part} | send me your dick pics and i will show you my ass | two men and a woman in bed, every orgasm filmed close up | they had sex all night, naked and moaning
en: horny singles near you want sex tonight | lonely wife wants a stranger to bang her hard, call now | free porn clips with horny wives and no sign-up | hot milf blowjob compilation, full length | uncensored hardcore xxx gallery, adults only | watch naked couples fuck live on cam tonight | download erotic gangbang scenes in full length, over eighteen only | busty adult models strip nude and moan for you | rent a slutty escort for an hour of anal pleasure | free xxx videos of naked teens | nude girls on cam, watch them masturbate | buy a blowjob tonight | hardcore anal porn, free download | cheap escort girls for sex near you | deepthroat and creampie videos
de: geile Fotzen warten heute Nacht auf dich | gratis Pornos ohne Anmeldung, nur für Erwachsene | sie lutschte seinen Schwanz, bis er kam | er fickte sie von hinten | geile Frauen wollen heute Sex | nackte Mädchen vor der Kamera, Pornos gratis | er leckte ihre Muschi, und sie stöhnte | Sexfilme mit geilen Hausfrauen | sie stöhnte nackt, als er in sie eindrang | billige Nutten in deiner Nähe
es: maduras cachondas buscan sexo esta noche | mujeres desnudas follan en directo, solo adultos | vídeos porno gratis sin registro | ella le chupó la polla hasta que se corrió | él se la folló por detrás | chicas desnudas quieren sexo contigo | le lamió el coño y ella gimió | putas baratas esta noche | vídeos de mamadas y corridas
fr: des femmes nues baisent en direct, réservé aux adultes | elle suce sa bite devant la caméra | vidéos porno gratuites sans inscription | il la baise par derrière et elle gémit | des salopes nues veulent du sexe ce soir | il lui lèche la chatte jusqu'à l'orgasme | films porno avec des femmes chaudes | elle se masturbe nue devant lui
ru: голые шлюхи в прямом эфире ждут тебя | бесплатное порно без регистрации, только для взрослых | она сосала его член, пока он не кончил | он трахал её всю ночь | голые девушки хотят секса сегодня | горячие минеты и порнуха | он вылизал ей киску, и она стонала | секс с шлюхами дёшево
ja: 無修正エロ動画が見放題 | 彼女は彼のペニスをしゃぶった | 裸の女がカメラの前でオナニー | 今夜セックスしたい人妻 | 巨乳娘の中出し動画 | 彼は彼女のおっぱいを舐めて挿入した | フェラとセックスの無料動画 | アダルト動画無料、十八歳以上のみ | 素人娘の喘ぎ声、無修正ポルノ | 全裸で喘ぐ女の動画
"""

PLAIN = """
en: our rules forbid hate speech, insults, threats and pornographic images | moderators removed the post because it threatened another member | the court sentenced a man for shouting racist abuse at refugees on a tram | the court convicted a man who had called his neighbour {ins} | he was convicted of murder and rape | the police say he was {harmed} on monday | a study shows how often women are insulted online | help for people who get insulted online: save the message and block the sender | the historian shows how propaganda once likened minorities to pests, and what followed | the historian describes how {grp} were called {deg} | women and refugees in the valley started a new choir | {grp} in the village started a new choir | a course for {grp} begins on monday | {grp} have the right to vote | we welcome {grp} to our town | {grp} were attacked last night, the police report | the clinic helps {grp} | the film, rated for adults, contains brief nudity and strong language | a sex education leaflet for adults covers consent, condoms and anal cancer screening | the clinic explains breast self-examination and when to see a doctor about nipple discharge | see a doctor if your penis hurts or your vagina itches | the doctor examined her breast and nipples | prostate and anal cancer screening for men | a study of intercourse between neighbouring villages in trade records | women who had sex without a condom should see a doctor | the nude painting hangs in the museum | the study of sexual health asked adults about orgasm and masturbation
en: to stop the job, kill the parent process and let the orphan child die | we killed the dragon, got beaten twice, and the old pig finally gave up its loot | you can kill the process and burn the disk image | shoot the photo and crop your picture | beat the eggs and cut your butter | i hope you get well soon | i hope you get beaten eggs right this time | you will hang the picture above your desk | this kettle is rubbish, the lid is ugly and i want my money back | i was such a fool to miss the sale, silly me | the donkey, or ass, carried two sacks of nuts past the slaughterhouse | the rat and vermin officer will treat the drains for parasites on monday | the virgin olive oil is pressed hard and left naked of any label | the dumb waiter and the bastard file are both still in the workshop | a pair of great tits and one blue-footed booby were seen near the cock pheasant pen | parasites, rats and cockroaches spread disease in the cellar | the rooster, a proud cock, woke you | your dog is a stupid breed but lovely | the garbage is collected from your house on friday | your pussy cat is lovely | what a stupid mistake, i am sorry | this is a damn good book, you will love it | the movie was shit but the popcorn was fine | my pig won a prize at the fair
en: {thing} {did} | {thing} {did}, before the rain set in | nobody in the valley says that {thing} {did} | you said {thing} {did} | your order has arrived and you can collect it | {thing} {did} and you should read the rules | he and she say {thing} {did} | thank you, {name}, you are very kind | {name}, you are right | you are welcome here | i will call you tonight | we will find you a seat | nobody would miss the train | watch your step | my dog got hurt but you will love him | she is a nurse and you should see her | i know where you bought it | the men and women of the choir met him and her | my wife and her husband are in bed with a cold | we accept cookies and show you adverts | contact us for more, call now | sign up free, no registration needed | watch the full length video on our site | adults only pay half after six | all rights reserved, home, about, login, next page
de: Beleidigungen und Pornografie sind in diesem Forum verboten | das Gericht verurteilte einen Mann wegen Beleidigung von Flüchtlingen | die Beratung erklärt die Brustuntersuchung und wann ein Arzt nötig ist | der Schädlingsbekämpfer sucht nach Ratten und Parasiten | der alte Müller zählte die grünen Stühle | {grp} gründen einen Chor | der Verein hilft, {grp} zu unterstützen | der Mann soll seine Frau {kill} wollen, sagt die Polizei | das Gericht verurteilte den Mann, der sie {kill} wollte | du bist herzlich willkommen | du bist sehr nett, danke | halt bitte an der Ecke | die nackte Wand ist frisch gestrichen | heute Nacht regnet es | nur für Erwachsene kostet der Eintritt mehr | die Klinik berät zu Sex und Verhütung | wer dich anruft, ist mein Bruder | der Zug hat gestern Verspätung gehabt
es: prohibidos los insultos y la pornografía en este foro | el juez condenó a un hombre por insultar a refugiados | la clínica explica la revisión de los pechos | {grp} fundan un coro | la ciudad ayuda a {grp} | {grp} tienen derecho a votar | el fontanero busca ratas y parásitos en el sótano | eres muy amable, gracias | eres bienvenido | te voy a llamar esta noche | te vamos a ayudar | cierra la puerta | un hombre quería {kill} a su mujer, dice la policía | la basura se recoge el viernes | la educación sexual en la escuela | el tren llegó tarde al muelle
fr: les insultes et la pornographie sont interdites sur ce forum | le tribunal a condamné un homme pour injures envers des réfugiés | la clinique explique le dépistage du cancer du sein | {grp} fondent une chorale | la ville aide {grp} | {grp} ont le droit de vote | l'agent cherche des rats et des parasites dans la cave | tu es très gentil, merci | vous êtes les bienvenus | je vais te rappeler ce soir | on va te montrer la ville | ferme ta porte | il a voulu {kill} sa femme, dit la police | l'ordure est ramassée vendredi | l'éducation sexuelle à l'école | le vieux moulin cherche encore deux caisses de pêches
ru: на форуме запрещены оскорбления и порнография | суд наказал мужчину за оскорбление беженцев | клиника рассказывает о здоровье груди | {grp} создали хор | город помогает, {grp} получили жильё | в подвале ищут крыс и паразитов | ты очень добр, спасибо | ты прав | я тебя найду в библиотеке | мы тебя ждём сегодня | тебе позвонят завтра | закрой дверь | суд осудил мужчину за убийство жены | урок о сексе и здоровье для взрослых | поезд пришёл поздно | старая мельница стоит у реки
ja: この掲示板では侮辱とポルノは禁止です | 裁判所は難民を侮辱した男に有罪を言い渡した | 病院は乳がん検診を説明する | {grp}のための合唱団ができた | {grp}を支援する会が開かれた | 地下室で害虫とネズミを駆除する | お前も一緒に来るか | あなたはとても親切です、ありがとう | 今夜電話します | 警察によると男が殺された | 歴史家は宣伝が少数者を害虫にたとえたと書く | 学校の性教育について医師が話した | 列車は遅れて到着した | 古い水車は川のそばにある | ゴミは金曜日に集めます | 女性と老人が公園を歩く
"""

KINDS = ("abuse", "hate", "sexual")
_SLOT = re.compile(r"\{(\w+)\}")


def lines(block: str) -> Iterator[tuple[str, str]]:
    """(language, sentence with slots) of a block."""
    for line in block.strip().split("\n"):
        language, _, rest = line.partition(": ")
        for sentence in rest.split(" | "):
            yield language, sentence.strip()


def filled(language: str, sentence: str, rng: np.random.Generator) -> str:
    def one(match: re.Match) -> str:
        options = (SLOTS.get(f"{language}.{match.group(1)}") or SLOTS[match.group(1)]).split("|")
        return options[int(rng.integers(len(options)))]

    return _SLOT.sub(one, sentence)


def sample(seed: int = 5, rounds: int = ROUNDS, leave_out: int | None = None, only: int | None = None) -> list[tuple[str, str, tuple[int, int, int]]]:
    """(language, sentence, whether it is abuse, hate, sexual) of the whole sample, or but for, or only of, a fifth of its lines."""
    rng = np.random.default_rng(seed)
    out = []
    for kind, block in (*zip(KINDS, (ABUSE, HATE, SEXUAL), strict=True), ("plain", PLAIN)):
        label = tuple(int(kind == k) for k in KINDS)
        for n, (language, sentence) in enumerate(lines(block)):
            drawn = {filled(language, sentence, rng) for _ in range(rounds if "{" in sentence else 1)}
            if n % 5 != leave_out and only in (None, n % 5):
                out += [(language, s, label) for s in sorted(drawn)]
    return out
